"""Hard negatives by an exact nearest-neighbour join over Voronoi cells.

Scores are integer inner products of vectors whose components were scaled and floored. With M the largest
norm, a vector x is augmented by sqrt(M^2 - |x|^2) and an anchor by 0: then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the
highest scores are the nearest vectors.

1. Pivots are vectors chosen by hash, about the square root of all, at most ``MOST_PIVOTS``. Every vector and
   every anchor goes to the cell of its nearest pivot.
2. A join inside the cells gives each anchor a score that its k-th best can't fall below (none where its cell
   has too few); cells cover all rows, and nothing but this bound comes from them.
3. A cell's anchors have a largest distance to the pivot, a largest distance at which a vector can still serve one
   of them, and a smallest one, where scores have an upper limit. A vector x can serve none of them if the
   triangle inequality, or the plane between their pivot and the vector's, keeps it too far or too near.
   Cells are put into anchor groups of about ``GROUP`` anchors, and a vector is copied to the groups, and only those, of
   which it might serve a cell.
4. Groups join locally, in units of a slice of the group's anchors and a block of its vectors, so a common
   vector, label or cell spreads over tasks. A unit's best k for each anchor are few rows, and the best of these are taken.

Positives are found so among the vectors of the anchor's label; bounds are kept for each cell and class of
labels (labels modulo ``CLASSES``). Negatives are found so among all others, for each anchor and
positive within the window of scores that the positive allows.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors shorter than the longest
count as 0 in the components they lack; the empty vector has score 0 with all. Repeated rows are rows of their own, so a copy of an anchor's
row may be its positive. Ties go to the smaller id; rows equal in score and id are interchangeable. An empty table gives an empty result. Other
columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from folioforge.llm.common import broadcast_if_small, staged

MOST_PIVOTS = 1024
CLASSES = 64
#: Anchors of a group, and of a slice of one.
GROUP = 256
#: Vectors of a block: between these, and about a 64th of all.
BLOCK = (256, 4096)
#: Rounding that bounds allow for, as a share of M.
SLACK = 1e-6
_NONE = np.iinfo(np.int64).min
_ANY = np.iinfo(np.int64).max


def prepared(rows: DataFrame, id_col: str, label_col: Column, vector_col: str, scale: int) -> DataFrame:
    """row (a number), id, label, v (array of long) of the rows that take part."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(scale * x.cast("double")).cast("long"))
    odd = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.col(id_col).isNotNull() & label_col.isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(odd, F.lit(False))
    kept = rows.where(whole).select(F.col(id_col).alias("id"), label_col.cast("long").alias("label"), v.alias("v"))
    return staged(kept.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


class Space:
    """Augmented vectors and their pivots."""

    def __init__(self, pivots: np.ndarray, most: float, dims: int):
        """pivots: whole vectors, padded. most: the largest squared norm."""
        self.dims, self.most = dims, most
        self.pivots = np.concatenate((pivots, self.rest(pivots)[:, None]), axis=1)
        self.norms = (self.pivots**2).sum(axis=1)
        self.apart = np.sqrt(np.maximum(0, self.norms[:, None] + self.norms[None] - 2 * self.pivots @ self.pivots.T))
        self.slack = SLACK * max(1.0, most**0.5)

    def rest(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.most - (x**2).sum(axis=1)))

    def distances(self, x: np.ndarray, *, anchor: bool = False) -> np.ndarray:
        """Of each vector to each pivot."""
        last = np.zeros(len(x)) if anchor else self.rest(x)
        norms = (x**2).sum(axis=1) + last**2
        dots = x @ self.pivots[:, :-1].T + last[:, None] * self.pivots[:, -1]
        return np.sqrt(np.maximum(0, norms[:, None] + self.norms - 2 * dots))

    def reach(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a vector has the score with the anchor; infinite for no score."""
        far = np.sqrt(np.maximum(0, (x**2).sum(axis=1) + self.most - 2 * score.astype(np.float64)))
        return np.where(score == _NONE, np.inf, far)


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of numbers as rows, zeros where they are shorter."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims)[None] < sizes[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors."""
    most = max(1, *(int(np.abs(m).max(initial=0)) for m in (a, b)))
    if most * most * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.array((a.astype(object) @ b.astype(object).T).tolist(), dtype=np.int64).reshape(len(a), len(b))


def cells(rows: DataFrame, space, *, anchor: bool) -> DataFrame:
    """``rows`` (a column v among them) with cell and dist, the nearest pivot and its distance."""
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("cell int, dist double").fields])
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = space.value
        for batch in batches:
            far = held.distances(matrix(batch.column(at), held.dims).astype(np.float64), anchor=anchor)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, type=pa.int32()), pa.array(far[np.arange(len(far)), cell])], names=schema.names)

    return rows.mapInArrow(run, schema)


def best_in_groups(queries: DataFrame, rows: DataFrame, dims: int, k: int, same: bool, block: int) -> DataFrame:
    """(q, other, other_id, score): for each query the best k of its group's rows.

    queries: group, q, row, label, v, low, high; scores are to lie between the last two. rows: group, row, id, label, v. ``same`` asks
    for other rows of the same label, else for other labels. Group, slice and block make a unit.
    """
    n_rows = rows.groupBy("group").agg(F.count("*").alias("n"))
    n_queries = queries.select("group", "row").distinct().groupBy("group").agg(F.count("*").alias("m"))  # queries of one anchor share a slice
    plan = staged(n_rows.join(n_queries, "group").select("group", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("m") / GROUP).cast("int").alias("slices")), "negatives-units")
    plan = broadcast_if_small(plan, plan.count())
    up_to = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda key, c: F.pmod(F.xxhash64(key), F.col(c)).cast("int")
    ours = queries.join(plan, "group").select("group", own("row", "slices").alias("slice"), up_to("blocks").alias("block"), "q", "row", "label", "v", "low", "high")
    theirs = rows.join(plan, "group").select("group", up_to("slices").alias("slice"), own("row", "blocks").alias("block"), "row", "id", "label", "v")
    schema = StructType([*StructType.fromDDL("q long, other long").fields, rows.schema["id"], *StructType.fromDDL("score long").fields])
    arrow = to_arrow_schema(schema)

    def unit(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not ours.num_rows or not theirs.num_rows:
            return arrow.empty_table()
        theirs = theirs.take(pc.sort_indices(theirs, sort_keys=[("id", "ascending"), ("row", "ascending")]))
        anchor, first, which = np.unique(ours.column("row").to_numpy(), return_index=True, return_inverse=True)
        score = products(matrix(ours.column("v").take(pa.array(first)), dims), matrix(theirs.column("v"), dims))
        label, other = ours.column("label").to_numpy()[first], theirs.column("label").to_numpy()
        fits = label[:, None] == other[None]
        fits = fits & (anchor[:, None] != theirs.column("row").to_numpy()[None]) if same else ~fits
        score[~fits] = _NONE
        score = score[which]
        low, high = (ours.column(c).to_numpy() for c in ("low", "high"))
        score[(score < low[:, None]) | (score > high[:, None])] = _NONE
        found = []
        each = np.arange(len(score))
        for _ in range(min(k, score.shape[1])):  # of equals the first, which has the least id
            at = score.argmax(axis=1)
            top = score[each, at]
            score[each, at] = _NONE
            hit = top != _NONE
            found.append((each[hit], at[hit], top[hit]))
        q, at, top = (np.concatenate(x) for x in zip(*found, strict=True))
        at = pa.array(at)
        return pa.Table.from_arrays([ours.column("q").take(pa.array(q)), theirs.column("row").take(at), theirs.column("id").take(at), pa.array(top)], schema=arrow)

    key = ["group", "slice", "block"]
    met = ours.groupBy(*key).cogroup(theirs.groupBy(*key)).applyInArrow(unit, schema)
    return best(met, k)


def best(found: DataFrame, k: int) -> DataFrame:
    """The best k of each q, with rank from 1."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def groups_of(sizes: dict[int, int], space: Space) -> np.ndarray:
    """The anchor group of each cell: cells in the order of their place along the pivots' main direction, cut at ``GROUP`` anchors."""
    spread = space.pivots - space.pivots.mean(axis=0)
    line = spread @ np.linalg.svd(spread, full_matrices=False)[2][0] if len(spread) > 1 else np.zeros(len(spread))
    out, group, held = np.zeros(len(line), dtype=np.int64), 0, 0
    for cell in np.lexsort((np.arange(len(line)), np.round(line, 6))).tolist():
        if held and held + sizes.get(cell, 0) > GROUP:
            group, held = group + 1, 0
        out[cell] = group
        held += sizes.get(cell, 0)
    return out


def copied(rows: DataFrame, space, bounds: DataFrame, group: np.ndarray, classes: int) -> DataFrame:
    """``rows`` for each anchor group of which they might serve a cell: column group.

    bounds: cell, class, widest (distance of an anchor to the pivot), far and near (between which a vector may
    serve one), a row a cell and class at most.
    """
    n = len(group)
    widest, far, near = np.full((n, classes), -1.0), np.full((n, classes), -1.0), np.full((n, classes), np.inf)
    for r in bounds.collect():  # at most MOST_PIVOTS * CLASSES
        widest[r["cell"], r["class"]], far[r["cell"], r["class"]], near[r["cell"], r["class"]] = r["widest"], r["far"], r["near"]
    sent = rows.sparkSession.sparkContext.broadcast((widest, far, near, group))
    kept = ["row", "id", "label", "v"]
    rows = rows.select(*kept)
    schema = StructType([*StructType.fromDDL("group long").fields, *rows.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (widest, far, near, group) = space.value, sent.value
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) > 0)))
        names = group[order][starts]
        for batch in (whole.slice(k, 1024) for whole in batches for k in range(0, whole.num_rows, 1024)):
            to = held.distances(matrix(batch.column(3), held.dims).astype(np.float64))
            kind = batch.column(2).to_numpy() % classes
            w, f, c = widest[:, kind].T, far[:, kind].T, near[:, kind].T
            own = to.argmin(axis=1)
            least = to[np.arange(len(to)), own][:, None]
            plane = (to**2 - least**2) / np.maximum(2 * held.apart[own], 1e-9)
            plane[held.apart[own] <= held.slack] = 0
            low = np.maximum(to - w, plane) - held.slack
            serves = (w >= 0) & (low <= f) & (to + w + held.slack >= c)
            some = np.logical_or.reduceat(serves[:, order], starts, axis=1)
            at, g = np.nonzero(some)
            yield pa.RecordBatch.from_arrays([pa.array(names[g], type=pa.int64()), *(col.take(pa.array(at)) for col in batch.columns)], names=schema.names)

    return rows.mapInArrow(run, schema)


def bounds_of(queries: DataFrame, space, classes: int) -> DataFrame:
    """(cell, class, widest, far, near) of queries (label, v, cell, dist, need, high)."""
    made = "cell int, class int, dist double, far double, near double"
    rows = queries.select("label", "v", "cell", "dist", "need", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = space.value
        for batch in batches:
            label, v, cell, dist, need, high = batch.columns
            x = matrix(v, held.dims).astype(np.float64)
            high = high.to_numpy()
            near = np.where(high == _ANY, 0.0, held.reach(x, high))
            yield pa.RecordBatch.from_arrays([cell, pa.array(label.to_numpy() % classes, type=pa.int32()), dist, pa.array(held.reach(x, need.to_numpy())), pa.array(near)], names=["cell", "class", "dist", "far", "near"])

    return rows.mapInArrow(run, made).groupBy("cell", "class").agg(F.max("dist").alias("widest"), F.max("far").alias("far"), F.min("near").alias("near"))


def nearest(queries: DataFrame, rows: DataFrame, space, group: np.ndarray, k: int, *, same: bool, block: int) -> DataFrame:
    """(q, other, id, score, rank): the best k rows of every query, exactly.

    queries: q, row, label, v, cell, dist, low, high. rows: row, id, label, v, cell.
    """
    dims, classes = space.value.dims, CLASSES if same else 1
    seeds = best_in_groups(queries.withColumn("group", F.col("cell").cast("long")), rows.withColumn("group", F.col("cell").cast("long")), dims, k, same, block)
    kth = staged(seeds.where(F.col("rank") == k).select("q", F.col("score").alias("kth")), "negatives-seeds")
    known = queries.join(broadcast_if_small(kth, kth.count()), "q", "left").withColumn("need", F.greatest("low", F.coalesce("kth", "low"))).drop("kth")
    known = staged(known, "negatives-queries")
    near = copied(rows, space, bounds_of(known, space, classes), group, classes)
    near = staged(near, "negatives-copies")
    held = F.array(*(F.lit(int(g)) for g in group)).cast("array<long>")
    return best_in_groups(known.withColumn("group", F.get(held, F.col("cell"))), near, dims, k, same, block)


def hard_negatives(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    anchor: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which ``anchor`` holds, a condition on the column "id"; by default those whose id is
    divisible by 50. For each anchor and each of its first ``positives`` other rows of its label come the first ``negatives``
    rows of other labels with window[0] * positive_score <= 100 * negative_score <= window[1] * positive_score.
    """
    context = rows.sparkSession.sparkContext
    table = prepared(rows, id_col, F.col(label) if isinstance(label, str) else label, vector_col, scale)
    sizes = table.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("most")).first()
    n, dims, most = sizes["n"], sizes["dims"] or 0, sizes["most"] or 0.0
    n_pivots = min(MOST_PIVOTS, int(max(1, n) ** 0.5) + 1)
    chosen = table.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(n_pivots).toArrow()
    pivots = matrix(chosen.column("v"), dims) if n else np.zeros((1, dims), dtype=np.int64)
    space = context.broadcast(Space(pivots.astype(np.float64), most, dims))
    block = int(min(BLOCK[1], max(BLOCK[0], n // 64)))

    all_rows = staged(cells(table, space, anchor=False).select("row", "id", "label", "v", "cell"), "negatives-cells")
    is_anchor = F.pmod(F.col("id"), F.lit(50)) == 0 if anchor is None else anchor
    limits = [F.lit(_NONE).alias("low"), F.lit(_ANY).alias("high")]
    anchors = staged(cells(table.where(is_anchor), space, anchor=True).select(F.col("row").alias("q"), "*", *limits), "negatives-anchors")
    counts = {r["cell"]: r["count"] for r in anchors.groupBy("cell").count().collect()}  # a row a pivot
    group = groups_of(counts, space.value)

    found = nearest(anchors, all_rows, space, group, positives, same=True, block=block)
    found = found.select("q", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = window
    each = found.join(anchors.drop("low", "high"), "q").withColumn("low", F.ceil(low * F.col("positive_score").cast("decimal(30,0)") / 100).cast("long"))
    each = each.withColumn("high", F.floor(high * F.col("positive_score").cast("decimal(30,0)") / 100).cast("long")).where("low <= high")
    each = staged(each.drop("q").withColumn("q", F.monotonically_increasing_id()), "negatives-pairs")
    worst = nearest(each.select("q", "row", "label", "v", "cell", "dist", "low", "high"), all_rows, space, group, negatives, same=False, block=block)
    worst = worst.select("q", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = each.select("q", F.col("id").alias("anchor_id"), "positive_id", "positive_score")
    return pairs.join(worst, "q").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def shifted_label(id_: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """Labels of which every seventh is moved to the next, as noise that mining has to bear."""
    return F.when(F.pmod(id_, F.lit(every)) == 0, (label + 1) % labels).otherwise(label)
