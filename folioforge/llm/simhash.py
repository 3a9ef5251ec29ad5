"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64 majority bits over the hashes of a text's word shingles. For a radius r, every bit
position i gets a vector m(i) of r + 1 bits, not zero, and every vector v that isn't zero gives a table
whose mask holds the positions with <m(i), v> odd. Up to r differing positions can't span r + 1
dimensions, so some v is orthogonal to all of them: every pair within the radius agrees on that
table's mask and meets in one of its buckets. No pair is missed.

Equal fingerprints are one node, so copies cost nothing here. A bucket of up to ``SMALL`` nodes is
compared pair by pair. In a larger bucket the nodes agree on the mask, so two of them are within
radius 2 exactly if they have a common neighbour at distance 0 or 1 among the positions outside the
mask: each node goes to the key of itself and of each such neighbour, and all nodes of a key link to
its least, with which they are within the radius by the triangle inequality. This is linear in the
bucket, exact, and covers the contract's radius of 2.

Texts are lower-cased in A-Z. A text with fewer words than a shingle is one shingle; null texts and
texts without words have fingerprint zero. Repeated rows share a node and a component.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import SPACES, broadcast_if_small, map_rows, packed, shuffled, staged, text_of
from folioforge.llm.components import components

SEED = 42
SMALL = 48
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = bytes.maketrans(SPACES.encode(), b" " * len(SPACES))
_STEP = 1 << 15


def words_of(text: str) -> list[bytes]:
    """UTF-8 words, A-Z lower-cased. No byte of a longer UTF-8 sequence is below 128."""
    return [w for w in text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACE).split(b" ") if w]


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of all shingles, repeats included."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    last = len(words) - size + 1
    return np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends[size - 1 :].tolist(), strict=True)),
        dtype=np.uint64,
        count=last,
    )


def majority(hashes: np.ndarray) -> int:
    """The fingerprint, as a signed 64-bit number: bits set in over half the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at : at + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprint(text: str, size: int, distinct_words: bool = False) -> int:
    words = words_of(text)
    if distinct_words:
        return majority(np.unique(shingle_hashes(words, 1)))
    return majority(shingle_hashes(words, size))


def fingerprints(docs: DataFrame, *, id_col: str, text_col: str, shingle: int = 3, distinct_words: bool = False) -> DataFrame:
    """(id, fp) for every row."""

    def start():
        return lambda texts: [[fingerprint(t, shingle, distinct_words) for t in texts]]

    bare = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return map_rows(bare, ["id"], start, "fp long")


def covering_masks(radius: int, seed: int = 7, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 masks as signed numbers; position vectors are dealt evenly, then shuffled."""
    n = (1 << (radius + 1)) - 1
    vectors = np.random.default_rng(seed).permutation([i % n + 1 for i in range(bits)])
    masks = []
    for v in range(1, n + 1):
        mask = sum(1 << i for i, m in enumerate(vectors) if bin(int(m) & v).count("1") % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _buckets(nodes: DataFrame, radius: int) -> DataFrame:
    """(fp, t, key, n): every node in every table's bucket that holds over one node, with the bucket's size."""
    masks = F.array(*(F.lit(m) for m in covering_masks(radius)))
    placed = nodes.select("fp", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("t", "key"))
    sizes = placed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    return placed.join(shuffled(sizes), ["t", "key"])


def _pairs(buckets: DataFrame) -> DataFrame:
    """Distinct pairs u < v of nodes that share a bucket; for buckets of bounded size."""
    other = buckets.select("t", "key", F.col("fp").alias("v"))
    met = buckets.withColumnRenamed("fp", "u").join(other, ["t", "key"]).where("u < v")
    return met.select("u", "v").distinct()


def links_within_two(nodes: DataFrame) -> DataFrame:
    """(u, v) edges whose components are those of the relation "2 or fewer differing bits"."""
    buckets = staged(_buckets(nodes, 2), "simhash-buckets")
    near = _pairs(buckets.where(F.col("n") <= SMALL)).where(distance(F.col("u"), F.col("v")) <= 2)
    masks = F.array(*(F.lit(m) for m in covering_masks(2)))
    flips = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)),
        lambda b: b.bitwiseAND(F.element_at(masks, F.col("t") + 1)) == 0,
    )
    keyed = buckets.where(F.col("n") > SMALL).select(
        "fp", "t", F.explode(F.concat(F.array("fp"), F.transform(flips, lambda b: F.col("fp").bitwiseXOR(b)))).alias("ball")
    )
    least = keyed.groupBy("t", "ball").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    star = keyed.join(shuffled(least), ["t", "ball"]).where("fp > least").select(F.col("least").alias("u"), F.col("fp").alias("v"))
    return near.union(star)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id, fp, component_id for every row: fingerprints link at 2 or fewer differing bits.

    component_id is the least id reachable. A null id is no smallest id: its component is that of the
    other rows, or null.
    """
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash-rows")
    nodes = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    found = components(links_within_two(nodes.select("fp")))
    owner = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = owner.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = owner.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---------------------------------------------------------------- near copies by similarity

#: Shingles that stand in COMMON or more texts of a sample come last in the order of shingles, the MOST_COMMON commonest of them.
#: The sample has about SAMPLE texts, and at least one of SHARE, so it follows the corpus.
SAMPLE, SHARE = 20_000, 64
COMMON = 3
MOST_COMMON = 400_000
#: Words of 64 bits in the parity sketch of a set of shingles.
SKETCH = 4


def _text_keys(shingle: int):
    def key(text: str) -> tuple[int, int, int, int]:
        raw, words = text.encode("utf-8", "surrogatepass"), words_of(text)
        h1, h2 = np.array([xxhash.xxh64_intdigest(raw, 1), xxhash.xxh64_intdigest(raw, 2)], dtype=np.uint64).view(np.int64).tolist()
        return h1, h2, majority(np.unique(shingle_hashes(words, 1))), majority(np.unique(shingle_hashes(words, shingle)))

    return lambda: lambda texts: list(zip(*map(key, texts)))


def _shingle_sets(size: int):
    def sets(texts: list[str]):
        return [[np.unique((shingle_hashes(words_of(t), size) >> np.uint64(32)).astype(np.uint32)).view(np.int32) for t in texts]]

    return lambda: sets


def _tables(nodes: DataFrame, radius: int) -> DataFrame:
    """(node, fp, check, t, key, n, least) of the nodes that share a bucket; least is the bucket's first node."""
    masks = F.array(*(F.lit(m) for m in covering_masks(radius)))
    placed = nodes.select("*", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("t", "key"))
    sizes = placed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    return placed.join(shuffled(sizes), ["t", "key"])


def _alike(pairs: DataFrame, bare: DataFrame, shingle: int, similarity: float, name: str) -> DataFrame:
    """The pairs (u, v) whose sets of shingles have the similarity. Only texts of nodes in pairs are read on.

    Those nodes are counted: if few, they are broadcast and no text moves.
    """
    pairs = staged(pairs, f"{name}-pairs", release=True)
    wanted = staged(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), f"{name}-nodes")
    texts = bare.withColumnRenamed("id", "node").join(broadcast_if_small(wanted, wanted.count()), "node")
    sets = staged(map_rows(texts, ["node"], _shingle_sets(shingle), "shingles array<int>").dropDuplicates(["node"]), f"{name}-sets", release=True)
    a, b = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(a, "u").join(b, "v").withColumn("shared", F.size(F.array_intersect("a", "b")))
    enough = F.col("shared") >= similarity * (F.size("a") + F.size("b") - F.col("shared"))
    return staged(both.where(enough & (F.col("shared") > 0)).select("u", "v"), f"{name}-links", release=True)


def _cut(levels: list[int], keys: list[int], most: int) -> tuple[int, int, int]:
    """(count, room, its keys): keys with greater counts are held, and of this count's keys a share that fills the room. Counts fall."""
    held = 0
    for n, own in zip(levels, keys, strict=True):
        if held + own > most:
            return n, most - held, own
        held += own
    return 0, 0, 1


def _common_shingles(bare: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the commonest shingles of a sample of the texts, by the order of the ids' hash.

    A shingle that isn't held stands in few texts: below COMMON * SHARE of a large corpus, as the sample has it, or in fewer than any that is.
    """

    def keys(texts: list[str]):
        sets = [np.unique(shingle_hashes(words_of(t), size)).view(np.int64) for t in texts]
        whole = np.concatenate([*sets, np.zeros(0, dtype=np.int64)])
        return np.zeros(len(whole), dtype=np.int64), [whole]

    every = max(1, min(SHARE, bare.count() // SAMPLE))
    sample = bare.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    counts = map_rows(sample, [], lambda: lambda ids, texts: keys(texts), "key long").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    counts = staged(counts, "similar-common")
    levels = counts.groupBy("n").agg(F.count("*").alias("keys")).orderBy(F.desc("n")).toArrow()  # a row for each count, so below the sample's texts
    least, room, wide = _cut(levels.column("n").to_pylist(), levels.column("keys").to_pylist(), MOST_COMMON)
    # sorted on no side: a sort with a limit would gather in rows on the driver, while these columns take 16 bytes a shingle
    some = F.pmod(F.xxhash64("key"), F.lit(wide)) < room
    held = counts.where((F.col("n") > least) | ((F.col("n") == least) & some)).toArrow()
    keys, n = held.column("key").to_numpy().view(np.uint64), held.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def prefix(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first of a set's shingles in the order of all shingles, rare ones first.

    Of two sets with the similarity, each has at least ``similarity`` of its shingles in the other, so
    the least shingle they share is among the first n - ceil(similarity * n) + 1 of either. This holds in
    any order; the common ones come last to keep the buckets small.
    """
    keys, n = common
    rank = np.zeros(len(hashes), dtype=np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        rank = np.where(keys[at] == hashes, n[at], 0)
    size = len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1
    return hashes[np.lexsort((hashes, rank))[:size]]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 * SKETCH classes whether it has an odd number of hashes. Sketches of two sets differ
    in at most as many bits as the sets differ in members."""
    odd = np.bincount((hashes % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(shingle: int, similarity: float, common):
    def start():
        def made(texts: list[str]):
            sets = [np.unique(shingle_hashes(words_of(t), shingle)) for t in texts]
            first = [prefix(s, common.value, similarity).view(np.int64) if len(s) else np.zeros(0, dtype=np.int64) for s in sets]
            return [[len(s) for s in sets], [sketch(s) for s in sets], first]

        return made

    return start


def _prefix_pairs(bare: DataFrame, groups: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs u < v of nodes of different groups, among them every such pair with the similarity.

    ``groups``: node, group. Nodes meet by the shingles of their prefixes. Only buckets with over one
    group are looked at, and there only pairs with an end outside the bucket's largest group, so a large
    group of copies costs its size times the number of strangers. Pairs are dropped whose sizes, places
    of the shared shingle or sketches rule the similarity out.
    """
    common = bare.sparkSession.sparkContext.broadcast(_common_shingles(bare, shingle))
    texts = bare.where("id is not null").withColumnRenamed("id", "node")
    made = map_rows(texts, ["node"], _prefixes(shingle, similarity, common), "size int, sketch array<long>, keys array<long>")
    made = staged(made.join(groups, "node").distinct(), "similar-prefixes", release=True)
    placed = made.select("node", "size", "group", F.posexplode("keys").alias("pos", "key"))
    mixed = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    mixed = staged(mixed, "similar-mixed", release=True)
    met = staged(placed.join(broadcast_if_small(mixed, mixed.count()), "key"), "similar-met", release=True)
    largest = met.groupBy("key", "group").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("group", F.struct("n", "group")).alias("largest"))
    full = met.join(shuffled(made.select("node", "size", "sketch").distinct()), ["node", "size"]).select("key", F.struct("node", "group", "size", "pos", "sketch").alias("y"))
    strangers = full.join(shuffled(largest), "key").where(F.col("y.group") != F.col("largest")).select("key", F.col("y").alias("x"))
    both = F.col("x.size") + F.col("y.size")
    apart = sum((distance(F.col("x.sketch")[k], F.col("y.sketch")[k]) for k in range(1, SKETCH)), distance(F.col("x.sketch")[0], F.col("y.sketch")[0]))
    allowed = (
        (F.col("x.group") != F.col("y.group"))
        & (F.least("x.size", "y.size") >= similarity * F.greatest("x.size", "y.size") - 1e-6)
        & (F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos")) * (1 + similarity) >= similarity * both - 1e-6)
        & (apart * (1 + similarity) <= (1 - similarity) * both + 1e-6)
    )
    pairs = strangers.join(shuffled(full), "key").where(allowed)
    return pairs.select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v")).distinct()


def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = 5, bits: tuple[int, int] = (8, 20), shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, group) for every distinct id: copies, and texts linked by a Jaccard similarity of their shingle sets.

    Two rounds:

    1. Fingerprints over the distinct words, in which near copies differ least, meet in covering tables:
       every node and the first node that any of its buckets offers, where fingerprints differ in up to
       bits[0] and those over the shingles in up to bits[1] bits. This joins most of a large group of
       copies in time linear in its size, and loses links; none of it decides what round 2 sees but the groups.
    2. Every pair that the similarity allows and that round 1 left in different groups, by ``_prefix_pairs``.

    In both the sets of shingles decide. A pair that round 2 doesn't look at is in one group or below the
    similarity, so the groups are those of all pairs.
    """
    bare = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = staged(map_rows(bare, ["id"], _text_keys(shingle), "h1 long, h2 long, fp long, check long"), "similar-rows")
    texts = rows.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.min("fp").alias("fp"), F.min("check").alias("check"))
    nodes = staged(texts.where("node is not null"), "similar-nodes")
    tables = staged(_tables(nodes.select("node", "fp", "check"), radius), "similar-tables", release=True)

    def near(a: str, b: str) -> Column:
        return (distance(F.col(f"{a}.fp"), F.col(f"{b}.fp")) <= bits[0]) & (distance(F.col(f"{a}.check"), F.col(f"{b}.check")) <= bits[1])

    first = tables.select("node", "fp", "check", "least").where("node > least").distinct().alias("x")
    owner = nodes.select(F.col("node").alias("least"), "fp", "check").alias("y")
    met = first.join(owner, (F.col("x.least") == F.col("y.least")) & near("x", "y"))
    round_1 = met.groupBy(F.col("x.node").alias("v")).agg(F.min("y.least").alias("u")).select("u", "v")
    links = _alike(round_1, bare, shingle, similarity, "similar-1")
    group = components(links).withColumnRenamed("component", "group")

    ids = nodes.select("node").distinct().join(group, "node", "left").select("node", F.coalesce("group", "node").alias("group"))
    round_2 = _prefix_pairs(bare, staged(ids, "similar-groups"), shingle, similarity)
    more = _alike(round_2, bare, shingle, similarity, "similar-2")

    found = components(links.union(more)).withColumnRenamed("component", "group")
    by_text = nodes.select("h1", "h2", "node").join(found, "node", "left").select("h1", "h2", F.coalesce("group", "node").alias("group"))
    return rows.join(by_text, ["h1", "h2"], "left").select(F.col("id").alias(id_col), "group").distinct()


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The document with the least id of each group, columns unchanged; of rows that repeat an id, one.

    Rows without id have no place in a group's order and stay. The ids to remove are counted: if few,
    they are broadcast and no text moves.
    """
    groups = similar_groups(docs, id_col=id_col, text_col=text_col, **how).where(F.col(id_col).isNotNull())
    gone = staged(groups.groupBy(F.col(id_col).alias("gone")).agg(F.min("group").alias("group")).where("gone > `group`").select("gone"), "similar-gone")
    again = staged(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again"), "similar-again")
    rows = packed(docs, key=F.col(id_col))
    rows = rows.join(broadcast_if_small(gone, gone.count()), F.col("key") == F.col("gone"), "left_anti")
    repeated = again.count()
    if not repeated:
        return rows.select("row.*")
    held = broadcast_if_small(again, repeated)
    once = rows.join(held, F.col("key") == F.col("again"), "left_anti")
    return once.union(rows.join(held, F.col("key") == F.col("again"), "left_semi").dropDuplicates(["key"])).select("row.*")
