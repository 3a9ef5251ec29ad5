"""Votes on translations as chapters arrive, with retraction when a chapter is extracted again.

An extraction is (chapter, version, pairs). State by chapter holds the pairs of its latest version; a later version takes back
those that it lacks and adds those that are new, an earlier one that comes late changes nothing. What changes is appended to a
log of (chapter, pos, cn, en, sign), exactly once through the checkpoint. The votes are those over the
log's live rows, so they equal the votes over each chapter's latest extraction, in whatever order and in however many
runs these came.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioforge.operators import glossary as G
from folioforge.session import ship

PAIRS = "array<struct<pos: long, cn: string, en: string>>"
EXTRACTION = f"chapter long, version long, pairs {PAIRS}"
CHANGE = "chapter long, pos long, cn string, en string, sign int"


def _changes(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = state.getOption
    version, before = (held[0], json.loads(held[1])) if held else (None, [])
    latest, now = version, before
    for part in parts:
        for v, pairs in zip(part["version"], part["pairs"], strict=True):
            if v is not None and (latest is None or int(v) > latest):
                latest, now = int(v), json.loads(pairs)
    if latest != version:
        old, new = {tuple(p) for p in before}, {tuple(p) for p in now}
        state.update((latest, json.dumps(now)))
        rows = [(int(key[0]), *p, -1) for p in sorted(old - new, key=repr)] + [(int(key[0]), *p, 1) for p in sorted(new - old, key=repr)]
        if rows:
            yield pd.DataFrame(rows, columns=["chapter", "pos", "cn", "en", "sign"])


def changes(extractions: DataFrame) -> DataFrame:
    """The log's rows of a stream (or table) of extractions; rows without chapter are left out."""
    ship(extractions.sparkSession)
    flat = F.to_json(F.transform(F.coalesce("pairs", F.array().cast(PAIRS)), lambda p: F.array(p["pos"].cast("string"), p["cn"], p["en"])))
    rows = extractions.where("chapter is not null").select("chapter", F.col("version").cast("string").alias("version"), flat.alias("pairs"))
    return rows.groupBy("chapter").applyInPandasWithState(_changes_of_text, CHANGE, "version long, pairs string", "append", GroupStateTimeout.NoTimeout)


def _changes_of_text(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    for found in _changes(key, parts, state):
        yield found.assign(pos=[None if p is None else int(p) for p in found["pos"]]).astype({"pos": "Int64"})


def follow(spark: SparkSession, folder: str, log: str, checkpoint: str) -> None:
    """Take in the extractions, JSON files, that came into ``folder`` since the last run."""
    found = spark.readStream.schema(EXTRACTION).json(folder)
    run = changes(found).writeStream.format("parquet").outputMode("append").option("path", log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


def live(log: DataFrame) -> DataFrame:
    """(chapter, pos, cn, en) that are in their chapter's latest extraction. Shuffles small rows; changes combine first."""
    return log.groupBy("chapter", "pos", "cn", "en").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")


def votes(log: DataFrame, **how) -> DataFrame:
    """(cn, en) by majority over the live rows; ``how`` goes to ``majority_vote``."""
    return G.majority_vote(G.pair_counts(live(log)), **how)
