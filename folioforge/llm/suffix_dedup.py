"""Exact substring deduplication by suffix sorting, deep-shallow.

A byte goes if a string of ``length`` (100) bytes that covers it also starts earlier: in a smaller id,
or earlier in the same text. Strings are judged on the input and never cross texts. That is: sort all
suffixes; in every run of suffixes that agree on their first 100 bytes all but the earliest are repeats.

Sorting every suffix of a large corpus would move 100 bytes for each byte of it. Only suffixes that can
repeat are sorted:

1. Anchors by winnowing: in every 100-byte string the 32-byte piece with the least hash, the rightmost
   of ties, is its anchor. This depends on the string's bytes alone, so equal strings have the same
   anchor at the same place. A rolling hash gives anchors for one position in about 35. Anchors that
   occur once are dropped; only their hashes have been moved.
2. Context: the bytes that the 100-byte strings of an anchor cover. Occurrences are grouped by (anchor,
   context) hashes with the earliest kept; a later one repeats all its strings. Copies of a text end here.
3. An anchor with several contexts is where repeats begin and end. The earliest occurrence of each such
   context fetches its bytes, and the suffixes that belong to the anchor are sorted in a task per anchor
   group: multikey quicksort to a shallow depth, then blind tries over the groups that still agree.
   Suffixes whose rolling hash is alone in their group are left out, since they repeat nothing; those
   sorted are compared by bytes. Runs of 100 agreeing bytes give the repeats.
   The contexts of a crowded anchor, one with over ``CROWD`` of them, are dealt out in lots of about
   ``CROWD``. Each lot is sorted, and the earliest of each of its strings goes on to be dealt out again,
   now with a hash of the string, until a lot holds all that is left of its strings: lots stay small
   however many texts have one passage in different surroundings.

Counting and minima combine before the shuffle, and hot anchors are split, so one passage in a third of
all texts spreads over the cluster. Ids of any type that can be ordered do. Null texts count as empty.
Rows with one id and one text are one text and share the result; rows with one id and different texts
are ordered by a hash of the texts. A null id counts as the smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from folioforge.llm.common import broadcast_if_small, map_rows, staged, text_of

LENGTH, PIECE = 100, 32
CROWD = 2_000
KEY, SHALLOW = 8, 24
#: Bytes of a text that are hashed at a time; bounds the arrays for very long texts.
STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Roller:
    """Hashes of substrings of one byte array from prefix sums of table values times powers of an odd base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(_BASE) ^ (seed * 4)
        self.inverse = pow(self.base, -1, 2**64)
        self.n = 0

    def load(self, data: np.ndarray) -> None:
        if len(data) + 1 > self.n:
            self.n = max(2 * self.n, len(data) + 1, 4096)
            self.up, self.down = _powers(self.n, self.base), _powers(self.n, self.inverse)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def pieces(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` neighbouring hashes the place of the least, the rightmost of ties."""
    value, place, width = hashes, np.arange(len(hashes)), 1

    def merge(shift: int):
        left, right = value[: len(value) - shift], value[shift:]
        take = right <= left
        return np.where(take, right, left), np.where(take, place[shift:], place[: len(place) - shift])

    while width * 2 <= span:
        value, place = merge(width)
        width *= 2
    if width < span:
        value, place = merge(span - width)
    return place


class Winnower:
    def __init__(self):
        self.one, self.two = Roller(1), Roller(2)

    def occurrences(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor hash, context hash, packed places) of the anchors of a text, a stretch of it at a time.

        The strings that belong to an anchor start at first..last; its context is the bytes they cover
        and where in them it stands. Anchor and context take different hash families: a pair has 128
        bits. An anchor whose strings a stretch's end parts comes twice, with its strings dealt out.
        """
        for begin in range(0, len(data) - LENGTH + 1, STRETCH):
            raw = np.frombuffer(data, dtype=np.uint8, offset=begin, count=min(STRETCH + LENGTH - 1, len(data) - begin))
            self.one.load(raw)
            self.two.load(raw)
            pieces = self.one.pieces(PIECE)
            chosen = anchors(pieces, LENGTH - PIECE + 1)
            first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
            place = chosen[first]
            last = np.concatenate((first[1:], [len(chosen)])) - 1
            shape = (place - first).astype(np.uint64)
            at = (place + begin) << 16 | (place - first) << 8 | (last - first)
            yield pieces[place], _mixed(self.two.hashes(first, last + LENGTH) ^ (shape << np.uint64(20))), at


# ---------------------------------------------------------------- deep-shallow sorting


def _blind_trie(group: list[int], text: bytes, starts: list[int], depth: int) -> list[list[int]]:
    """Sorts suffixes that agree on ``depth`` bytes; returns the runs that agree on LENGTH bytes, in order.

    A blind trie keeps in each inner node only the place where its branches part and the byte of each
    branch. An insertion goes down blindly to some leaf, compares with that leaf once to find where the
    two part, and enters there.
    """
    root = group[0]  # a leaf is a suffix; an inner node is [place, {byte: node}]
    same: dict[int, list[int]] = {root: [root]}
    for s in group[1:]:
        node, a = root, starts[s]
        while type(node) is list:
            branch = node[1].get(text[a + node[0]])
            node = branch if branch is not None else next(iter(node[1].values()))
        b = starts[node]
        if text[a + depth : a + LENGTH] == text[b + depth : b + LENGTH]:
            same[node].append(s)
            continue
        part = _agree(text, a, b, depth)
        same[s] = [s]
        above, way, at = None, None, root
        while type(at) is list and at[0] < part:
            above, way = at, text[a + at[0]]
            at = at[1][way]
        if type(at) is list and at[0] == part:
            at[1][text[a + part]] = s
            continue
        new = [part, {text[b + part]: at, text[a + part]: s}]
        if above is None:
            root = new
        else:
            above[1][way] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is list:
            stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
        else:
            out.append(same[node])
    return out


def _agree(text: bytes, a: int, b: int, depth: int) -> int:
    """Common prefix length of the different strings at a and b, known to be at least depth."""
    low, high = depth, LENGTH - 1
    while low < high:
        mid = (low + high + 1) // 2
        if text[a + depth : a + mid] == text[b + depth : b + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def deep_shallow(text: bytes, starts: list[int]) -> list[list[int]]:
    """Indexes of ``starts`` in the order of the strings of LENGTH bytes there; equal strings make one run.

    Multikey quicksort parts the suffixes by KEY bytes at a time, three ways round a pivot, down to
    SHALLOW bytes; blind tries order the groups that agree so far.
    """
    out: list[list[int]] = []
    stack = [(list(range(len(starts))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group)
            continue
        if depth >= SHALLOW:
            out += _blind_trie(group, text, starts, depth)
            continue
        keys = [text[a : a + KEY] for a in [starts[s] + depth for s in group]]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less = [s for s, k in zip(group, keys) if k < pivot]
        equal = [s for s, k in zip(group, keys) if k == pivot]
        if len(less) + len(equal) < len(group):
            stack.append(([s for s, k in zip(group, keys) if k > pivot], depth))
        stack.append((equal, depth + KEY))
        if less:
            stack.append((less, depth))
    return out


def repeats(text: bytes, starts: list[int], order: list) -> list[int]:
    """Indexes into starts of the strings that an earlier one equals; ``order`` says which is earlier."""
    found: list[int] = []
    for run in deep_shallow(text, starts):
        if len(run) > 1:
            first = min(run, key=order.__getitem__)
            found.extend(x for x in run if x != first)
    return found


# ---------------------------------------------------------------- the operator

#: ``at`` packs the anchor's place, how far before it its first string starts, and how many more follow:
#: place << 16 | (place - first) << 8 | (last - first). Both distances are below LENGTH.
_OCCURRENCE = "a long, c long, at long"


def _find_anchors():
    winnow = Winnower()

    def found(texts: list[str]):
        parts, size = [], 0
        for k, text in enumerate(texts):
            for got in winnow.occurrences(text.encode("utf-8", "surrogatepass")):
                parts.append((k, got))
                size += len(got[0])
                if size > 100_000:
                    yield frame(parts)
                    parts, size = [], 0
        if parts:
            yield frame(parts)

    def frame(parts):
        at = np.repeat([k for k, _ in parts], [len(p[0]) for _, p in parts])
        return at, [np.concatenate([p[c] for _, p in parts]).view(np.int64) for c in range(3)]

    return found


def _context_bytes():
    """Texts and their lists of asked occurrences become rows with an occurrence's own bytes."""

    def found(texts: list[str], asked: list[list[dict]]):
        at, rows, size = [], [], 0
        for k, (text, own) in enumerate(zip(texts, asked, strict=True)):
            data = text.encode("utf-8", "surrogatepass")
            for x in own:
                at.append(k)
                rows.append((x["a"], x["n"], x["first"], data[x["first"] : x["last"] + LENGTH]))
                if len(rows) > 50_000:
                    yield at, list(zip(*rows))
                    at, rows = [], []
        if rows:
            yield at, list(zip(*rows))

    return found


class _Sorter:
    """Collects whole groups of occurrences and sorts the suffixes of many groups at a time."""

    def __init__(self):
        self.roller = Roller(3)
        self.clear()

    def clear(self) -> None:
        self.groups: list[list[tuple]] = []
        self.size = 0

    def add(self, rows: list[tuple]) -> None:
        """rows: (doc, ver, first, bytes), of one anchor."""
        self.groups.append(rows)
        self.size += sum(len(r[3]) for r in rows)

    def sort(self, earliest: bool) -> tuple[list[tuple], list[tuple]]:
        """(doc, ver, start, end) to remove of the groups held, which are let go; and where asked for,
        (group's number, doc, ver, first, string) of the earliest of each string of a group."""
        if not self.groups:
            return [], []
        rows = [r for g in self.groups for r in g]
        text = b"".join(r[3] for r in rows)
        size = np.array([len(r[3]) for r in rows], dtype=np.int64)
        base = np.cumsum(size) - size
        count = size - (LENGTH - 1)
        row = np.repeat(np.arange(len(rows)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = base[row] + within
        group = np.repeat(np.arange(len(self.groups)), [len(g) for g in self.groups])[row]
        self.roller.load(np.frombuffer(text, dtype=np.uint8))
        key = _mixed(self.roller.hashes(start, start + LENGTH) + group.astype(np.uint64) * _BASE)
        by_key = np.argsort(key, kind="stable")
        line = key[by_key]
        alike = np.concatenate(([False], line[1:] == line[:-1], [False]))
        kept = np.sort(by_key[alike[1:] | alike[:-1]])
        out: list[tuple] = []
        stays = np.ones(len(start), dtype=bool)
        edges = np.flatnonzero(np.diff(group[kept], prepend=-1, append=-1))
        starts, owners, places = start[kept].tolist(), row[kept].tolist(), within[kept].tolist()
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            owner = [(*rows[r][:2], rows[r][2] + p) for r, p in zip(owners[a:b], places[a:b], strict=True)]
            found = repeats(text, starts[a:b], owner)
            stays[kept[a + np.array(found, dtype=np.int64)]] = False
            for doc, ver, p in sorted(owner[x] for x in found):
                if out and out[-1][:2] == (doc, ver) and out[-1][2] <= p <= out[-1][3]:
                    out[-1] = (doc, ver, out[-1][2], p + LENGTH)
                else:
                    out.append((doc, ver, p, p + LENGTH))
        first = []
        if earliest:
            for k in np.flatnonzero(stays).tolist():
                doc, ver, p, _ = rows[row[k]]
                first.append((int(group[k]), doc, ver, int(p + within[k]), text[start[k] : start[k] + LENGTH]))
        self.clear()
        return out, first


def _sort_all(earliest: bool):
    """Over partitions sorted by group: sorts each group's suffixes. With ``earliest``, rows without an end
    hold the earliest of each string, its anchor and the anchor's number of contexts."""
    names = ["doc", "ver", "start", *(["end", "a", "n", "bytes"] if earliest else ["end"])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, anchor, held, anchors_, sorter = None, None, {}, [], _Sorter()

        def close():
            if len(held) > 1 or (held and earliest):
                sorter.add([(*k, v) for k, v in held.items()])
                anchors_.append(anchor)
            held.clear()

        def done() -> pd.DataFrame:
            spans, first = sorter.sort(earliest)
            rows = spans
            if earliest:
                rows = [(*s, 0, 0, None) for s in spans] + [(doc, ver, p, -1, *anchors_[g], data) for g, doc, ver, p, data in first]
            anchors_.clear()
            return pd.DataFrame(rows, columns=names)

        for batch in batches:
            for g, a, n, doc, ver, first, data in batch.itertuples(index=False, name=None):
                if g != key:
                    close()
                    key, anchor = g, (a, n)
                    if sorter.size > 2_000_000:
                        yield done()
                held[doc, ver, first] = data
        close()
        yield done()

    return run


def _cut():
    def cut(text: str, spans: list[dict] | None):
        data = text.encode("utf-8", "surrogatepass")
        kept, at, removed, n = hashlib.sha256(), 0, 0, 0
        for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
            if s > at or not n:
                kept.update(data[at:s])
                n += 1
                at = s
            if e > at:
                removed += e - at
                at = e
        kept.update(data[at:])
        return len(data), removed, n, kept.hexdigest()

    return lambda texts, spans: list(zip(*map(cut, texts, spans)))


def _first(at: Column) -> Column:
    return (F.shiftright(at, 16) - F.shiftright(at, 8).bitwiseAND(255)).cast("int")


def _last(at: Column) -> Column:
    return (_first(at) + at.bitwiseAND(255)).cast("int")


def _grouped(rows: DataFrame, *keys: Column) -> DataFrame:
    """``rows`` in whole groups by the keys' hash."""
    return rows.select(F.xxhash64(*keys).alias("g"), "a", "n", "doc", "ver", "first", "bytes").repartition("g").sortWithinPartitions("g")


def _lots(n: Column, level: int) -> Column:
    return F.ceil(n / float(CROWD**level))


def removed_spans(texts: DataFrame) -> DataFrame:
    """(doc, ver, start, end) intervals to remove of (doc, ver, text) rows; they may touch or overlap."""
    seen = map_rows(texts, ["doc", "ver"], _find_anchors, _OCCURRENCE)
    shared = staged(seen.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "suffix-shared", release=True)
    dup = staged(seen.join(shared, "a"), "suffix-anchors", release=True)

    contexts = staged(
        dup.groupBy("a", "c").agg(F.min(F.struct("doc", "ver", "at")).alias("e"), F.count("*").alias("n")), "suffix-contexts", release=True
    )
    copies = contexts.where("n > 1").select("a", "c", "e")
    later = (
        dup.join(copies, ["a", "c"])
        .where(F.struct("doc", "ver", "at") != F.col("e"))
        .select("doc", "ver", _first(F.col("at")).alias("start"), (_last(F.col("at")) + LENGTH).alias("end"))
    )
    several = staged(contexts.groupBy("a").agg(F.count("*").alias("n")).where("n > 1"), "suffix-several")
    most = several.agg(F.max("n")).first()[0] or 0
    asked = (
        contexts.drop("n")
        .join(several, "a")
        .groupBy(F.col("e.doc").alias("doc"), F.col("e.ver").alias("ver"))
        .agg(F.collect_list(F.struct("a", "n", _first(F.col("e.at")).alias("first"), _last(F.col("e.at")).alias("last"))).alias("asked"))
    )
    with_bytes = staged(
        map_rows(texts.join(asked, ["doc", "ver"]), ["doc", "ver"], _context_bytes, "a long, n long, first int, bytes binary"), "suffix-bytes", release=True
    )
    key = ", ".join(f"{c} {with_bytes.schema[c].dataType.simpleString()}" for c in ("doc", "ver"))
    out = _grouped(with_bytes.where(F.col("n") <= CROWD), F.col("a")).mapInPandas(_sort_all(False), f"{key}, start int, end int").union(later)

    left, level, last = with_bytes.where(F.col("n") > CROWD), 1, most <= CROWD
    while not last:
        last = CROWD**level >= most  # then these lots are whole
        # single strings from the second level on; their hash splits what is left of an anchor
        split = F.pmod(F.xxhash64("bytes"), _lots(F.col("n"), 1) * 64) if level > 1 else F.lit(0)
        lot = F.pmod(F.xxhash64("doc", "ver", "first"), _lots(F.col("n"), level))
        more = "" if last else ", a long, n long, bytes binary"
        sorted_ = _grouped(left, F.col("a"), split, lot).mapInPandas(_sort_all(not last), f"{key}, start int, end int{more}")
        sorted_ = staged(sorted_, f"suffix-lots-{level}", release=True)
        out = out.union(sorted_.where("end >= 0").select("doc", "ver", "start", "end"))
        if not last:
            left = sorted_.where("end < 0").withColumnRenamed("start", "first")
        level += 1
    return out


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Texts are told apart by id; where ids repeat or are null by a 63-bit hash of the text too. The ids
    that repeat are counted: if few, they are broadcast and no text moves.
    """
    kind = docs.schema[id_col].dataType
    whole = isinstance(kind, IntegralType)
    id_, text = F.col(id_col).cast("long" if whole else "string"), text_of(text_col)
    again = staged(docs.where(F.col(id_col).isNotNull()).groupBy(id_.alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again"), "suffix-again")
    rows = docs.select(id_.alias("id"), text.alias("text"))
    repeated = again.count()
    if repeated:
        rows = rows.join(broadcast_if_small(again, repeated), F.col("id") == F.col("again"), "left")
    else:
        rows = rows.withColumn("again", F.lit(None).cast("long" if whole else "string"))
    hashed = F.xxhash64("text").bitwiseAND(2**63 - 1)
    ver = F.when(F.col("id").isNull(), -hashed - 1).when(F.col("again").isNotNull(), hashed).otherwise(F.lit(0).cast("long"))
    texts = rows.select(F.coalesce("id", F.lit(-(2**63) if whole else "")).alias("doc"), ver.alias("ver"), "text")
    spans = removed_spans(texts).groupBy("doc", "ver").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = staged(spans, "suffix-spans", release=True)
    cut = map_rows(texts.join(spans, ["doc", "ver"], "left"), ["doc", "ver"], _cut, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return cut.select(F.when(F.col("ver") >= 0, F.col("doc")).cast(kind).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")
