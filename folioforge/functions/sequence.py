"""Ordered arrays of paragraphs: chunking, merging, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.replace import rotate_phrases
from folioforge.functions.text import cleanup_paragraph, rstrip, split_paragraphs, strip


def chunk_sizes(lengths: Column, most: int, separator: int = 2) -> Column:
    """Number of paragraphs in each chunk, greedily: a new chunk begins where a non-empty one would pass ``most``.

    Each paragraph costs its length plus ``separator``. One that alone is too long is its own chunk. The
    fold keeps the sizes of closed chunks, the open one's size and its cost, so its state grows by
    chunks and not by paragraphs.
    """
    zero = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("total"))

    def step(s: Column, length: Column) -> Column:
        cost = length.cast("long") + separator
        full = (s["n"] > 0) & (s["total"] + cost > most)
        return F.struct(
            F.when(full, F.concat(s["done"], F.array(s["n"]))).otherwise(s["done"]).alias("done"),
            F.when(full, 1).otherwise(s["n"] + 1).alias("n"),
            F.when(full, cost).otherwise(s["total"] + cost).alias("total"),
        )

    return F.aggregate(lengths, zero, step, lambda s: F.when(s["n"] > 0, F.concat(s["done"], F.array(s["n"]))).otherwise(s["done"]))


def chunk_ids(lengths: Column, most: int, separator: int = 2) -> Column:
    """Chunk number of each paragraph."""
    return F.flatten(F.transform(chunk_sizes(lengths, most, separator), lambda n, k: F.array_repeat(k, n)))


def chunks(paragraphs: Column, most: int = 7000, separator: int = 2) -> Column:
    """Array of chunks, each an array of paragraphs."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,n:int>>").alias("cuts"))
    sizes = chunk_sizes(F.transform(paragraphs, F.length), most, separator)
    cuts = F.aggregate(
        sizes,
        zero,
        lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["cuts"], F.array(F.struct(s["at"].alias("at"), n.alias("n")))).alias("cuts")),
        lambda s: s["cuts"],
    )
    return F.transform(cuts, lambda c: F.slice(paragraphs, c["at"] + 1, c["n"]))


def one_word_pattern(words: list[str]) -> str:
    return rf"(?iu)^[¡!¿?]*(?:{'|'.join(words)})[.!?¡¿]*$"


def merge_one_word(paragraphs: Column, words: list[str]) -> Column:
    """One-word paragraphs go to the end of the one before, after a dash, with their opening mark.

    The first paragraph stays whatever it is; a run of one-word paragraphs goes to the same head, an
    emptied paragraph too can be a head.
    """
    pattern = one_word_pattern(words)

    def opened(p: Column) -> Column:
        p = F.when(F.endswith(p, F.lit("!")) & ~F.startswith(p, F.lit("¡")), F.concat(F.lit("¡"), p)).otherwise(p)
        return F.when(F.endswith(p, F.lit("?")) & ~F.startswith(p, F.lit("¿")), F.concat(F.lit("¿"), p)).otherwise(p)

    def step(done: Column, p: Column) -> Column:
        join = (F.size(done) > 0) & strip(p).rlike(pattern)
        head = F.concat(rstrip(F.element_at(done, -1)), F.lit(" —"), opened(strip(p)))
        return F.when(join, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(head))).otherwise(F.concat(done, F.array(p)))

    return F.aggregate(paragraphs, F.array().cast("array<string>"), step)


def cleanup_chapter(paragraphs: Column, rules: list, phrases: list, words: list[str]) -> Column:
    """Cleanup of each paragraph, rotation over the whole chapter, merging, and no empty paragraphs."""
    text = F.array_join(F.transform(paragraphs, lambda p: cleanup_paragraph(p, rules)), "\n\n")
    merged = merge_one_word(F.split(rotate_phrases(text, phrases), "\n\n", -1), words)
    return split_paragraphs(F.array_join(merged, "\n\n"))


def paragraph_rows(df: DataFrame, key: str, paragraphs: Column) -> DataFrame:
    """(key, pos, paragraph)."""
    return df.select(key, F.posexplode(paragraphs).alias("pos", "paragraph"))


def merge_rows(rows: DataFrame, key: str, words: list[str]) -> DataFrame:
    """merge_one_word over (key, pos, paragraph) rows, for texts with very many paragraphs: gaps and islands."""
    pattern = one_word_pattern(words)
    order = Window.partitionBy(key).orderBy("pos")
    p = strip(F.col("paragraph"))
    head = ~p.rlike(pattern) | (F.row_number().over(order) == 1)
    marked = rows.select(key, "pos", "paragraph", head.alias("_head")).withColumn("_group", F.sum(F.col("_head").cast("int")).over(order))
    p = strip(F.col("paragraph"))
    opened = F.when(p.endswith("!") & ~p.startswith("¡"), F.concat(F.lit("¡"), p)).otherwise(p)
    opened = F.when(opened.endswith("?") & ~opened.startswith("¿"), F.concat(F.lit("¿"), opened)).otherwise(opened)
    part = F.when(F.col("_head"), F.col("paragraph")).otherwise(F.concat(F.lit(" —"), opened))
    groups = marked.groupBy(key, "_group").agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("pos", part.alias("p")))).alias("_parts"))
    parts = F.col("_parts")
    whole = F.when(F.size(parts) > 1, F.concat(rstrip(parts[0]["p"]), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), lambda x: x["p"]), ""))).otherwise(parts[0]["p"])
    return groups.select(key, "pos", whole.alias("paragraph"))


def fixed_blocks(df: DataFrame, order: list[str], size: int, parts: int = 256) -> DataFrame:
    """``block``: position in the order, by ``size``; rows equal in the order share their places at random.

    Rows are cut into ``parts`` ranges at sampled quantiles of the first column, which must be a number.
    Counts of the ranges add up over one small table; positions inside are a window per range. So no
    task numbers all rows.
    """
    first = order[0]
    cuts = sorted(set(df.approxQuantile(first, [i / parts for i in range(1, parts)], 1 / (4 * parts)))) if parts > 1 else []
    held = F.array(*(F.lit(float(c)) for c in cuts)).cast("array<double>")
    part = F.size(F.filter(held, lambda c: c < F.col(first)))
    ranged = df.withColumn("_part", part)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))  # at most ``parts`` + 1 rows
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    out = ranged.join(F.broadcast(counts), "_part").withColumn("_at", place)
    return out.withColumn("block", F.expr(f"_at div {size}").cast("long")).drop("_part", "_before", "_at")


def range_blocks(df: DataFrame, number: str, start: int, count: int, patience: int = 3) -> DataFrame:
    """``block``: (number - start) by ``count``. Blocks after ``patience`` empty ones in a row are dropped."""
    rows = df.where(F.col(number) >= start).withColumn("block", F.expr(f"(`{number}` - {start}) div {count}").cast("long"))
    present = rows.select("block").distinct()
    # a block that has one of the next ``patience`` after it goes on; the first that hasn't is the last
    followed = present.select(F.explode(F.sequence(F.col("block") - patience, F.col("block") - 1)).alias("block"))
    begin = present.sparkSession.range(-1, 0).select(F.col("id").alias("block"))
    last = present.union(begin).join(followed, "block", "left_anti").agg(F.min("block").alias("_last"))  # one row
    return rows.join(F.broadcast(last), F.col("block") <= F.col("_last")).drop("_last")


def numbered(df: DataFrame, order: list[str], parts: int = 256) -> DataFrame:
    """``place``: position in the order, from 0, nulls first; rows equal in the order share their places at random.

    Rows are cut into about ``parts`` ranges at values of the order, taken from a sample by hash; counts of the ranges add up over
    one small table, and positions inside are a window a range. Any cuts give right places.
    """
    key = F.struct(*order)
    sample = df.select(*order).distinct().orderBy(F.xxhash64(*order), *order).limit(16 * parts)
    values = sample.orderBy(*order).collect()[15::16]  # at most ``parts``
    types = {f.name: f.dataType for f in sample.schema.fields}
    cuts = F.array(*(F.struct(*(F.lit(v[c]).cast(types[c]).alias(c) for c in order)) for v in values)) if values else None
    ranged = df.withColumn("_part", F.lit(0) if cuts is None else F.size(F.filter(cuts, lambda c: c < key)))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))  # a row a range
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(F.broadcast(counts), "_part").withColumn("place", F.col("_before") + inside).drop("_part", "_before")
