"""Importance resampling toward a target distribution by bucket-partitioned inverted postings.

Features are runs of words, hashed to buckets. A bucket's gain is the scaled log ratio of its smoothed
shares in the target corpus and in the documents; a document's weight is the floored mean of the
gains of its features. Documents are drawn without replacement by the largest weight plus Gumbel noise
made of their ids.

1. Every text becomes postings (bucket, document, count), summed inside the document. They are written
   once, a row a document, so texts are read once. The buckets are cut into ``PARTS`` ranges.
2. Postings are shuffled by (range, salt), a document's salt being a hash of its row. So a bucket that all
   documents have, or all the postings of a common passage, spread over tasks of about ``UNIT``
   documents each, at any size.
3. The counts of both corpora, summed before their shuffle, meet by bucket; a range's counts go to each of its
   salts. There they are co-grouped with the postings, the bucket's gain is computed and each
   document's sum over the range goes out: one row a document and range.
4. These are summed by document.
5. The drawn ones are ranked by a range sort over (score, id): no task orders all rows.

The tables of counts have at most ``buckets`` rows. Null and empty texts have no feature and weight 0.
Repeated rows count each time and get rows of their own. A null id draws noise as the empty text. Rows equal in score and
id share their places at random. With an empty target corpus gains are those of its smoothing alone.
Empty documents give an empty result. Other columns don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from folioforge.llm.common import ROWS, broadcast_if_small, staged, text_of

PARTS = 32
UNIT = 2048
#: The bytes of a word: ASCII digits and lower-case letters, and all bytes of other characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCALE = 4294967296


class Buckets(dict):
    """The bucket of a feature; remembered, for a bounded number of features."""

    MOST = 500_000

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > self.MOST:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: str, longest: int) -> tuple[list[bytes], int]:
    """(all runs of 1 to ``longest`` words, joined by a space; the number of words). A-Z become a-z."""
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    runs = list(words)
    for size in range(2, longest + 1):
        runs += [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]
    return runs, len(words)


def bags(docs: DataFrame, id_col: str | None, text_col: str, buckets: int, longest: int) -> DataFrame:
    """row (a number), id, n_words, n_features, parts: an array of (part, buckets, counts), ranges and their buckets ascending."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), (F.col(id_col) if id_col else F.lit(None).cast("long")).alias("id"), text_of(text_col).alias("text"))
    width = -(-buckets // PARTS)
    made = StructType.fromDDL("n_words long, n_features long, parts array<struct<part: int, buckets: array<int>, counts: array<long>>>")
    schema = StructType([rows.schema["row"], rows.schema["id"], *made.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(buckets)
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            keys, words, total = [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                own, n = features(text, longest)
                keys.append(k * buckets + np.fromiter(map(known.__getitem__, own), dtype=np.int64, count=len(own)))
                words.append(n)
                total.append(len(own))
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            doc, bucket = key // buckets, key % buckets
            part = bucket // width
            first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])))) if len(key) else np.zeros(0, dtype=np.int64)
            cuts = pa.array(np.concatenate((first, [len(key)])), type=pa.int32())
            kind = arrow.field("parts").type.value_type
            lists = [pa.ListArray.from_arrays(cuts, pa.array(v, type=t)) for v, t in ((bucket, pa.int32()), (count, pa.int64()))]
            structs = pa.StructArray.from_arrays([pa.array(part[first], type=pa.int32()), *lists], fields=[pa.field(kind.field(k).name, v) for k, v in enumerate((pa.int32(), lists[0].type, lists[1].type))])
            of = pa.array(np.searchsorted(doc[first], np.arange(batch.num_rows + 1)), type=pa.int32())
            parts = pa.ListArray.from_arrays(of, structs)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, type=pa.int64()), pa.array(total, type=pa.int64()), parts.cast(arrow.field("parts").type)], schema=arrow)

    return rows.mapInArrow(run, schema)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(part, bucket, n) over the postings of ``bags``."""
    postings = docs.select(F.inline("parts")).select("part", F.inline(F.arrays_zip(F.col("buckets").alias("bucket"), F.col("counts").alias("count"))))
    return postings.groupBy("part", "bucket").agg(F.sum("count").alias("n"))


def gains(s: np.ndarray, t: np.ndarray, all_s: int, all_t: int, buckets: int) -> np.ndarray:
    """Of buckets that the documents have s times and the target t times."""
    s, t = s.astype(np.float64), t.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (float(all_s) + buckets) / ((s + 1) * (float(all_t) + buckets)))).astype(np.int64)


def contributions(docs: DataFrame, counts: DataFrame, totals: tuple[int, int], buckets: int, salts: int) -> DataFrame:
    """(row, gain): a document's gains over each range that it has features in."""
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt")
    postings = docs.select("row", salt, F.inline("parts")).select("part", "salt", "row", "buckets", "counts")
    by_part = counts.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("bucket", "s", "t"))).alias("held"))  # a range of buckets
    held = by_part.select("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), *(F.col(f"held.{c}").alias(c) for c in ("bucket", "s", "t")))
    all_s, all_t = totals

    def unit(postings: pa.Table, held: pa.Table) -> pa.Table:
        if not postings.num_rows:
            return pa.table({"row": pa.array([], type=pa.int64()), "gain": pa.array([], type=pa.int64())})
        own, s, t = (held.column(c).combine_chunks().flatten().to_numpy() for c in ("bucket", "s", "t"))
        gain = gains(s, t, all_s, all_t, buckets)
        lists = postings.column("buckets").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        each = gain[np.searchsorted(own, lists.flatten().to_numpy())] * postings.column("counts").combine_chunks().flatten().to_numpy()
        sums = np.add.reduceat(each, np.cumsum(sizes) - sizes)  # no list is empty
        return pa.table({"row": postings.column("row"), "gain": pa.array(sums, type=pa.int64())})

    return postings.groupBy("part", "salt").cogroup(held.groupBy("part", "salt")).applyInArrow(unit, "row long, gain long")


def noise(id_: Column, seed: int) -> Column:
    """Scaled Gumbel noise made of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / SCALE)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, from 0, in the order of the columns: ranges are sorted on their own, and the numbers
    of rows in the ranges before one add up over one row a range."""
    line = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    line = staged(line, "resample-line")
    range_ = F.shiftright("at", 33).alias("range")
    counts = line.groupBy(range_).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = staged(counts.select("range", before.alias("before")), "resample-ranges")
    held = broadcast_if_small(counts, counts.count())
    return line.withColumn("range", range_).join(held, "range").withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("range", "before", "at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = 10_000,
    longest: int = 1,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """id, n_features, weight, score and rank (from 1; null where not drawn) of every row: of the documents with
    ``least_words`` the ``percent`` with the highest scores are drawn."""
    ours = staged(bags(docs, id_col, text_col, buckets, longest), "resample-bags")
    theirs = bags(target, None, target_text_col, buckets, longest)
    both = bucket_counts(ours).select("part", "bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    both = both.union(bucket_counts(theirs).select("part", "bucket", F.lit(0).cast("long"), "n"))
    counts = staged(both.groupBy("part", "bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "resample-counts")
    all_s, all_t = (n or 0 for n in counts.agg(F.sum("s"), F.sum("t")).first())
    n_docs, eligible = ours.agg(F.count("*"), F.count_if(F.col("n_words") >= least_words)).first()
    parts = contributions(ours, counts, (all_s, all_t), buckets, max(1, -(-n_docs // UNIT)))

    base = ours.select("row", "id", "n_words", "n_features")
    none = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ("id", "n_words", "n_features")]
    rows = base.withColumn("gain", F.lit(0).cast("long")).union(parts.select("row", *none, "gain"))
    by_doc = rows.groupBy("row").agg(*(F.max(c).alias(c) for c in ("id", "n_words", "n_features")), F.sum("gain").alias("gain"))
    n = F.col("n_features")
    weight = F.when(n > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0).cast("long")
    scored = by_doc.select("row", "id", "n_words", "n_features", weight.alias("weight")).withColumn("score", (F.col("weight") + noise(F.col("id"), seed)).cast("long"))
    drawn = percent * eligible // 100
    able = F.col("n_words") >= least_words
    line = ranked(scored, [(~able).asc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()])
    rank = F.when(able & (F.col("place") < drawn), F.col("place") + 1)
    return line.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.cast("long").alias("rank"))
