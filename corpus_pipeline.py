"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import decontaminate, mixing, quality_rules, secrets, simhash
from folioforge.llm.common import discard, scratch, stored
from folioforge.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the decision list and the base limits keep."""
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: five-word shingles, similarity 0.8."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship(spark)
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets cut out of the texts; n_chars counts what is left."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with how many it takes."""
    return mixing.mix(docs, keep=["text", "lang", "n_chars"]).where("taken > 0")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing to target weights", mix),
]

#: Hashing, learning and graph search are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. A stage's own tables and its input go when its result is written."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs, path = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last:
            discard(spark, last)
        last = path
    return docs
