"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

1. Sizes: words per document; totals per source (one row a source goes to the driver).
2. Targets: sources in code-point order, null last, take the weights in turn. They share all words
   by weight; a target stops at ``epochs`` times its source and the excess is shared again by weight.
3. Apportionment: words are cut into blocks of equal token counts, ``LARGEST`` or, for sources whose target holds
   few of these, the next power of two that makes about a thousand of it; sources with one size of block share their seats. Blocks go
   to sources by the highest quotients ``target / (2k + 1)``, then within a source to its shards by the same rule, so
   every shard has an integer quota. A tiny source so has small blocks, and no other has.
4. Seeded selection: a shard lines its documents up in the order of a seeded hash and cuts the line into
   blocks. A quota takes whole passes over the line and then as many blocks as it has left, chosen by a
   seeded permutation of the shard's blocks, the last of them in part where words are left over. What
   a document gives is the overlap of its words with the chosen blocks; only blocks that it lies in are
   looked at.

A shard holds about ``shard_docs`` documents, so that a source with a third of all rows spreads over
many tasks; the number of shards is below ``MOST_SHARDS`` plus the number of sources at any size,
which bounds what the driver collects.

Null texts and empty texts have size 0 and are returned with taken 0. Rows that repeat an id are
rows of their own; rows equal in id and size may swap places without a change in the result. An
empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

import heapq
import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import broadcast_if_small, staged, word_count

MOST_SHARDS = 65_536


def targets_of(sizes: list[tuple[str | None, int]], weights=(1, 2, 3), epochs: float = 3) -> dict:
    """Target words by source: weighted shares of all words, capped at epochs times the source."""
    order = sorted((s for s, _ in sizes if s is not None)) + [None] * any(s is None for s, _ in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    most = {s: float(epochs * n) for s, n in sizes}
    left, free, target = float(sum(n for _, n in sizes)), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most[s]]
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = most[s]
            left -= most[s]
        free = [s for s in free if s not in target]
    return target


def sainte_lague(votes, seats: int, caps) -> np.ndarray:
    """Seats by the highest quotients votes / (2k + 1), at most caps each; ties go to the first."""
    votes, caps = np.asarray(votes, dtype=float), np.asarray(caps, dtype=np.int64)
    caps = np.where(votes > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)

    def given(divisor):
        return np.minimum(caps, np.floor(votes / divisor + 0.5)).astype(np.int64)

    low, high = votes[votes > 0].min() / (2.0 * seats + 4), votes.max() * 4
    while given(low).sum() < seats:
        low /= 2
    for _ in range(200):  # a divisor that hands out too few seats, barely
        mid = (low + high) / 2
        if given(mid).sum() <= seats:
            high = mid
        else:
            low = mid
    got = given(high)
    queue = [(-votes[i] / (2 * got[i] + 1), i) for i in np.flatnonzero(got < caps)]
    heapq.heapify(queue)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(queue, (-votes[i] / (2 * got[i] + 1), i))
    return got


#: Words of a block at most, blocks that a source's target should have, and blocks that a source may have.
LARGEST, BLOCKS, MOST_BLOCKS = 1024, 1000, 1 << 22


def block_of(target: float, size: int) -> int:
    """Words of a source's blocks."""
    wanted = max(1, int(target / BLOCKS), size // MOST_BLOCKS)
    return min(1 << (wanted.bit_length() - 1), LARGEST)


ROUNDS = 3


def permutation(seed: int, k: int, shard: int, blocks: int) -> tuple[int, int, list[int], list[int]]:
    """(blocks, bits, factors, shifts) of a permutation of the shard's blocks but the last, see ``rank_of``."""
    rng = random.Random(f"{seed}/{k}/{shard}")
    bits = max(1, (max(1, blocks) - 2).bit_length())
    return max(1, blocks), bits, [rng.randrange(1 << 20) | 1 for _ in range(ROUNDS)], [rng.randrange(1 << 20) for _ in range(ROUNDS)]


def rank_of(b: Column, blocks: Column, bits: Column, factors: Column, shifts: Column) -> Column:
    """The place of block ``b`` among a shard's blocks.

    Numbers of ``bits`` bits are permuted by rounds of an odd factor, a shift and a fold of the upper bits onto the lower; one
    that falls outside goes round again. The last block, which may be short, comes last, so whole blocks are
    chosen before it and a quota is met to the word.
    """
    mask = F.expr("shiftleft(1L, _bits)") - 1
    half = F.floor(bits / 2).cast("int") + 1

    def turned(x: Column) -> Column:
        for r in range(ROUNDS):
            x = (x * factors[r] + shifts[r]).bitwiseAND(mask)
            x = x.bitwiseXOR(F.call_function("shiftright", x, half))
        return x

    inside = F.aggregate(F.sequence(F.lit(1), F.lit(64)), turned(b), lambda x, _: F.when(x >= blocks - 1, turned(x)).otherwise(x))
    return F.when(b == blocks - 1, b).otherwise(inside)


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(1, 2, 3),
    epochs: int = 3,
    seed: int = 20_24,
    shard_docs: int = 512,
    keep: list[str] | None = None,
) -> DataFrame:
    """Words that the mix takes of every document.

    Returns id, source, size, source_size, target, taken, and the columns named by ``keep``.
    """
    spark = docs.sparkSession
    keep = [c for c in keep or [] if c not in (id_col, source_col)]
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        word_count(F.col(text_col)).alias("_size"),
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
    )
    bare = staged(sized.select("_id", "_source", "_size"), "mix-sizes")
    if not keep:
        sized = bare

    by_source = bare.groupBy("_source").agg(F.count("*").alias("n"), F.sum("_size").alias("size")).collect()
    totals = {r["_source"]: (r["n"], r["size"]) for r in by_source}
    goal = targets_of([(s, size) for s, (_, size) in totals.items()], weights, epochs)
    names = list(goal)
    all_docs = sum(n for n, _ in totals.values())
    per_shard = max(shard_docs, math.ceil(all_docs / MOST_SHARDS))
    catalogue = spark.createDataFrame(
        [(k, s, math.ceil(totals[s][0] / per_shard), totals[s][1], float(goal[s])) for k, s in enumerate(names)],
        "_k int, _name string, _shards int, source_size long, target double",
    )
    catalogue = broadcast_if_small(catalogue, len(names))

    def place(rows: DataFrame) -> DataFrame:
        found = rows.join(catalogue, F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_hash", F.xxhash64(F.lit(seed), F.col("_id")))
        return found.withColumn("_shard", F.pmod(F.col("_hash"), F.col("_shards")).cast("int"))

    cells = sorted(
        (r["_k"], r["_shard"], r["t"])
        for r in place(bare).groupBy("_k", "_shard").agg(F.sum("_size").alias("t")).collect()
    )
    block = np.array([block_of(goal[s], totals[s][1]) for s in names], dtype=np.int64)
    tokens = np.array([t for _, _, t in cells], dtype=np.int64)
    at = np.array([k for k, _, _ in cells], dtype=np.int64)
    most = (epochs * tokens) // block[at]
    source_caps = np.bincount(at, weights=most, minlength=len(names)).astype(np.int64)
    targets = np.array([goal[s] for s in names], dtype=float)
    quotas = np.zeros(len(names), dtype=np.int64)
    for size in np.unique(block):
        own = np.flatnonzero(block == size)
        quotas[own] = sainte_lague(targets[own], round(targets[own].sum() / size), source_caps[own])
    quota = np.zeros(len(cells), dtype=np.int64)
    edges = np.searchsorted(at, np.arange(len(names) + 1))  # cells are in the order of sources
    for k, own in enumerate(map(slice, edges[:-1], edges[1:])):
        quota[own] = sainte_lague(tokens[own], int(quotas[k]), most[own])
    rows = [
        (int(k), int(j), int(q * n // max(t, 1)), *divmod(int(q * n % max(t, 1)), n), n, *permutation(seed, k, j, -(-t // n)))
        for (k, j, t), q, n in zip(cells, quota, block[at].tolist(), strict=True)
    ]
    plan = spark.createDataFrame(rows, "_k int, _shard int, _passes long, _whole long, _part long, _block long, _blocks long, _bits int, _factors array<long>, _shifts array<long>")

    line = Window.partitionBy("_k", "_shard").orderBy("_hash", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    lined = place(sized).withColumn("_end", F.sum("_size").over(line)).join(
        broadcast_if_small(plan, len(rows)), ["_k", "_shard"]
    )
    start, end = F.col("_end") - F.col("_size"), F.col("_end")

    size = F.col("_block")

    def given(b):
        rank = rank_of(b, *(F.col(c) for c in ("_blocks", "_bits", "_factors", "_shifts")))
        taken = F.when(rank < F.col("_whole"), size).when(rank == F.col("_whole"), F.col("_part")).otherwise(0)
        return F.greatest(F.least(end, b * size + taken) - F.greatest(start, b * size), F.lit(0))

    own = F.sequence(F.expr("(_end - _size) div _block"), F.expr("(_end - 1) div _block"))
    chosen = F.when(F.col("_size") > 0, F.aggregate(own, F.lit(0).cast("long"), lambda s, b: s + given(b))).otherwise(0)
    return lined.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        F.col("_size").cast("long").alias("size"),
        F.col("source_size").cast("long"),
        F.col("target"),
        (F.col("_passes") * F.col("_size") + chosen).cast("long").alias("taken"),
        *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)),
    )
