"""Association mining between the two sides of aligned pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.sequence import numbered
from folioforge.session import ship, work_folder

#: Entities in more than MANY keys, and in more than one of OFTEN of them, meet words as pairs; the others' words travel as arrays of up to PIECE numbers.
MANY, OFTEN, PIECE = 1_000, 50, 512
#: The least number of slices of entities, how many meetings of entity and word a slice has about, and how many a task counts at a time.
SLICES, MEETINGS, LOT = 256, 1 << 25, 1 << 22


def tokens(df: DataFrame, key: str, text_col: str, name: str, pattern: str = r"[A-Za-z]{4,}", tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, name): the distinct tokens of each row's text. ``tokenizer`` makes an array of strings of the text's
    column (an expression, or a pandas UDF around a segmenter or a name recognizer); else ``pattern`` finds them."""
    found = tokenizer(F.col(text_col)) if tokenizer else F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0))
    return df.select(key, F.explode(F.array_distinct(found)).alias(name)).distinct()


def lift(entities: DataFrame, words: DataFrame, key: str, *, support: int = 2, lift_above: float = 5.0, confidence_above: float = 0.3, seeds: DataFrame | None = None) -> DataFrame:
    """(entity, word, n, confidence, lift, score): the best word for each entity.

    Counts are over the keys that both sides have, N in number: n where entity and word meet, #E and #W
    where each stands. confidence = n / #E; lift = confidence / (#W / N); score = lift * ln(n + 1) *
    confidence. The word with the greatest score, of equals the first by name, is taken and only then
    held against the thresholds. Entities and words below ``support`` go before the join, which keeps
    it small; seeds (entity, word) win over what is mined.

    A word that stands in total / lift_above keys or more can't exceed ``lift_above``, but may win and so
    leave its entity without a word. Its score is at most lift_above * ln(#E + 1): such words meet only the
    entities whose best other word passes the thresholds without exceeding that.

    Most pairs meet once, so pairs aren't shuffled: words are numbered, entities are dealt to slices, each key's words go
    as an array, once, to the slices that its entities are in, and a task counts them there. Entities that stand in many keys, of which there are at most
    ``OFTEN`` times a key's, meet words in over ``confidence_above`` of #E keys only, few enough to be counted
    in the tasks; other words can't pass, but may win, and meet those entities whose best word they could still beat.
    """
    spark = entities.sparkSession
    ship(spark)
    entities, words = _kept(entities, "entities"), _kept(words, "words")
    shared = _kept(entities.select(key).distinct().join(words.select(key).distinct(), key), "keys")
    total = shared.count()
    e_counts = entities.join(shared, key, "left_semi").groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    w_counts = words.join(shared, key, "left_semi").groupBy("word").agg(F.count("*").alias("n_w")).where(F.col("n_w") >= support)
    # by number of keys, then by name: of words in equally many keys the first has the least place
    named = _kept(numbered(_kept(w_counts, "counts"), ["n_w", "word"]).withColumn("place", F.col("place").cast("int")), "places")
    e = _kept(entities.join(shared, key, "left_semi").join(e_counts, "entity"), "entity-rows")
    w = _kept(words.join(shared, key, "left_semi").join(named, "word").select(key, "place", "n_w"), "word-rows")
    common, often = F.col("n_w") * lift_above >= total, (F.col("n_e") > MANY) & (F.col("n_e") * OFTEN > total)
    likely = F.col("n_w") > F.col("n_e") * (confidence_above * (1 - 1e-9))
    order = Window.partitionBy("entity").orderBy(F.desc(F.round("score", 9)), "word")

    def best(counts: DataFrame) -> DataFrame:
        out = counts.where(F.col("n") >= support).join(named, "place")
        out = out.withColumn("confidence", F.col("n") / F.col("n_e")).withColumn("lift", F.col("confidence") / (F.col("n_w") / F.lit(total)))
        out = out.withColumn("score", F.col("lift") * F.log(F.col("n") + 1) * F.col("confidence"))
        return out.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")

    def met(some_e: DataFrame, some_w: DataFrame, where: Column) -> DataFrame:
        return best(some_e.join(some_w, key).where(where).groupBy("entity", "n_e", "place").agg(F.count("*").alias("n")))

    passes = (F.col("lift") > lift_above) & (F.col("confidence") > confidence_above)
    seldom = best(_counted(e.where(~often), w.where(~common), key, named, total, support))
    frequent = met(e.where(often), w.where(~common & (F.col("n_w") > confidence_above * MANY * (1 - 1e-9))), likely)
    rare = _kept(seldom.union(frequent.select(seldom.columns)).where(passes), "best")
    log_e, log_w = F.log(F.col("n_e") + 1), F.log(F.col("n_w") + 1)
    held = rare.select("entity", F.col("score").alias("_best"))
    open_to = e.join(held.join(e_counts, "entity").where(F.col("_best") <= lift_above * log_e + 1e-6).select("entity"), "entity", "left_semi")
    over = met(open_to, w.where(common), F.lit(True))
    could = F.col("n_w") * F.lit(total) / (F.col("n_e") * F.col("n_e")) * log_w >= F.col("_best") - 1e-6
    under = met(e.where(often).join(held, "entity"), w.where(~common), ~likely & could)
    rivals = over.union(under.select(over.columns)).withColumn("_k", F.row_number().over(order)).where("_k = 1").select("entity", F.round("score", 9).alias("_score"), F.col("word").alias("_word"))
    mine = F.round("score", 9)
    wins = F.col("_score").isNull() | (mine > F.col("_score")) | ((mine == F.col("_score")) & (F.col("word") < F.col("_word")))
    good = rare.join(rivals, "entity", "left").where(wins).select("entity", "word", "n", "confidence", "lift", "score")
    if seeds is None:
        return good
    fixed = seeds.select("entity", F.col("word").alias("_seed"))
    return good.join(fixed, "entity", "full_outer").withColumn("word", F.coalesce("_seed", "word")).drop("_seed")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, f"lift-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counted(e: DataFrame, w: DataFrame, key: str, named: DataFrame, total: int, support: int) -> DataFrame:
    """(entity, n_e, place, n): for each entity the words with its greatest score or nearly that, of those in equally many keys the first."""
    steps = named.groupBy("n_w").agg(F.min("place").alias("first")).orderBy("first").collect()  # as many as there are different counts
    first, n_w = (np.array([r[c] for r in steps], dtype=np.int64) for c in ("first", "n_w"))
    lists = w.groupBy(key).agg(F.sort_array(F.collect_list("place")).alias("places"))
    sizes = e.groupBy(key).agg(F.count("*").alias("_n")).join(lists.select(key, F.size("places").alias("_m")), key)
    meetings = sizes.agg(F.sum(F.col("_n") * F.col("_m"))).head()[0] or 0
    dealt = e.withColumn("slice", F.pmod(F.xxhash64("entity"), F.lit(max(SLICES, -(-meetings // MEETINGS)))))
    dealt = dealt.groupBy("slice", key).agg(F.collect_list(F.struct("entity", "n_e")).alias("entities"))
    starts = F.sequence(F.lit(1), F.size("places"), F.lit(PIECE))
    pieces = lists.select(key, F.explode(F.transform(starts, lambda k: F.slice("places", k, PIECE))).alias("places"))
    dealt = dealt.join(pieces, key).select("slice", "entities", "places").repartition("slice").sortWithinPartitions("slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            own = batch.column("slice").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if held and b > a and held[0].column("slice")[0].as_py() != own[a]:
                    yield from _nearly_best(pa.concat_batches(held), first, n_w, total, support)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from _nearly_best(pa.concat_batches(held), first, n_w, total, support)

    return dealt.mapInArrow(run, "entity string, n_e long, place int, n long")


def _nearly_best(rows: pa.RecordBatch, first: np.ndarray, n_w: np.ndarray, total: int, support: int) -> Iterator[pa.RecordBatch]:
    """A slice's entities, some at a time, by the meetings with their keys' words."""
    entities, places = rows.column("entities"), rows.column("places")
    names, flat = entities.flatten(), places.flatten().to_numpy()
    coded = names.field(0).dictionary_encode()
    codes, of_e = coded.indices.to_numpy().astype(np.int64), names.field(1).to_numpy()
    key = np.repeat(np.arange(len(rows)), entities.value_lengths().to_numpy())
    size = places.value_lengths().to_numpy().astype(np.int64)
    starts = np.cumsum(size) - size
    order = np.argsort(codes, kind="stable")
    codes, of_e, key = codes[order], of_e[order], key[order]
    ends = np.append(np.flatnonzero(np.diff(codes)) + 1, len(codes))  # of each entity's keys
    met = np.cumsum(size[key])
    a = 0
    while a < len(codes):
        before = met[a - 1] if a else 0
        fits = ends[(ends > a) & (met[ends - 1] - before <= LOT)]
        b = int(fits[-1] if len(fits) else ends[np.searchsorted(ends, a, side="right")])
        n_of = size[key[a:b]]
        at = np.repeat(starts[key[a:b]] - (np.cumsum(n_of) - n_of), n_of) + np.arange(n_of.sum())
        pairs, n = np.unique(np.repeat(codes[a:b] << 32, n_of) | flat[at], return_counts=True)
        pairs, n = pairs[n >= support], n[n >= support]
        code, place = pairs >> 32, pairs & 0xFFFFFFFF
        n_e, of_w = of_e[np.searchsorted(codes, code)], n_w[np.searchsorted(first, place, side="right") - 1]
        score = (n / n_e) ** 2 * total / of_w * np.log(n + 1)
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        most = np.repeat(np.maximum.reduceat(score, begins), np.diff(begins, append=len(code))) if len(code) else score
        near = np.flatnonzero(score >= most - 1e-8 - 1e-9 * most)
        same = np.zeros(len(near), dtype=bool)
        same[1:] = (np.diff(code[near]) == 0) & (np.diff(of_w[near]) == 0) & (np.diff(n[near]) == 0)
        near = near[~same]
        made = [coded.dictionary.take(pa.array(code[near])), pa.array(n_e[near]), pa.array(place[near].astype(np.int32)), pa.array(n[near].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(made, names=["entity", "n_e", "place", "n"])
        a = b
