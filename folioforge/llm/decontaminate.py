"""Benchmark decontamination by template canonicalisation.

Texts become templates: words are lower-cased and stripped of punctuation, and numbers, units and names
become typed placeholders, <NUM>, <UNIT> and <NAME>. A window of ``width`` template tokens is hashed;
windows with fewer than half literal words are left out, since placeholders alone say nothing. Windows
of the words themselves are hashed too, whatever they are: those of items as written and in lower case,
those of documents as written, so that verbatim and lower-cased copies are found where slots are many or
names are spelt as other words. Items shorter than a window are one window. The windows of documents
are joined to those of the items by hash.

Matching windows of a document and an item that lie on one diagonal (document position minus item
position) are one alignment. Along it every slot must be filled consistently: the k-th value of a
type in the item stands for one value in the document and the other way round, so re-parameterised
questions match and texts that merely share a shape don't. An item is found in a document if an
alignment that is consistent covers at least ``coverage`` of the item's tokens, or PASSAGE of them.

The items go to all executors when their texts are below ``MOST_CHARACTERS``, which bounds the
broadcast; beyond it the documents' windows are joined by shuffle. Either way a document's matches are
few rows: only windows that an item has, or that pass a filter of the items' hashes, leave the map side.

Null and empty texts match nothing. Repeated rows share their id's result; rows without id that of their
text. Items that are null or have
no word are ignored. Items are told apart by their rows: several texts may share an id, which is found if one of them is, and
items without id are found as null. With no items nothing matches.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import broadcast_if_small, map_rows, packed, staged, text_of

#: Characters of items' texts that travel to the executors.
MOST_CHARACTERS = 16_000_000
WIDTH = 8
#: So many tokens of an item are a passage of it, however long the item is.
PASSAGE = 16
NUM, UNIT, NAME = "<NUM>", "<UNIT>", "<NAME>"
SLOTS = (NUM, UNIT, NAME)
#: Units and number words.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb oz ml l s sec secs second seconds min mins minute minutes h hour hours day days week weeks month months "
    "year years meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters inch inches foot feet yard yards mile "
    "miles gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars cent cents euro euros percent degree degrees".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
_TOKEN = re.compile(r"[$€£]?\d[\d.,:/]*%?|[^\W_]+(?:['’][^\W\d_]+)*|[.!?]+|\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END, _NUM, _UNIT, _CAP = 1, 2, 4, 8


class Template:
    """A text's template: ``slots`` says for each token whether it is literal (0) or which of SLOTS (1..3).

    ``hashes`` are the template's, ``written`` and ``lower`` those of the words as written and in lower case.
    """

    __slots__ = ("hashes", "kept", "lower", "slots", "words", "written")

    def __init__(self, words: list[str], kept: np.ndarray, slots: np.ndarray, hashes: np.ndarray, written: np.ndarray, lower: np.ndarray):
        self.words, self.kept, self.slots, self.hashes, self.written, self.lower = words, kept, slots, hashes, written, lower

    def __len__(self) -> int:
        return len(self.slots)

    def value(self, i: int) -> str:
        return self.words[self.kept[i]].lower()

    def token(self, i: int) -> str:
        return SLOTS[self.slots[i] - 1] if self.slots[i] else self.value(i)


class Templates:
    """Makes templates. A word is looked at once; its class and hash are remembered, for a bounded number of words.

    A capitalised word is a name unless it begins a sentence or line. A unit counts right after a number.
    """

    MOST = 500_000

    def __init__(self):
        self.slot_hashes = np.array([0, *(xxhash.xxh64_intdigest(s, 11) for s in SLOTS)], dtype=np.uint64)
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers(self._learn)
        self.flags, self.word_hashes, self.raw_hashes = np.zeros(1 << 12, dtype=np.int8), np.zeros(1 << 12, dtype=np.uint64), np.zeros(1 << 12, dtype=np.uint64)

    def _learn(self, word: str, number: int) -> None:
        if number >= len(self.flags):
            self.flags, self.word_hashes, self.raw_hashes = (np.concatenate((a, np.zeros_like(a))) for a in (self.flags, self.word_hashes, self.raw_hashes))
        low, c = word.lower(), word[0]
        flags = 0
        if c in ".!?\n":
            flags = _END
        elif c.isdigit() or c in "$€£" or low in NUMBER_WORDS:
            flags = _NUM
        else:
            flags = _UNIT * (low in UNITS) + _CAP * (c.isupper() and not word.isupper())
        self.flags[number] = flags
        self.word_hashes[number] = xxhash.xxh64_intdigest(low, 11)
        self.raw_hashes[number] = self.word_hashes[number] if low == word else xxhash.xxh64_intdigest(word, 11)

    def make(self, text: str) -> Template:
        if len(self.known) > self.MOST:
            self.forget()
        words = _TOKEN.findall(text)
        ids = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        flags = self.flags[ids]
        end = flags == _END
        begins = np.concatenate(([True], end[:-1]))[: len(end)]
        kept = np.flatnonzero(~end)
        flags, begins = flags[kept], begins[kept]
        number = flags == _NUM
        after = np.concatenate(([False], number[:-1]))[: len(number)]
        unit = (flags & _UNIT > 0) & after
        name = (flags & _CAP > 0) & ~begins & ~unit
        slots = number + 2 * unit + 3 * name
        lower = self.word_hashes[ids[kept]]
        return Template(words, kept, slots, np.where(slots > 0, self.slot_hashes[slots], lower), self.raw_hashes[ids[kept]], lower)

    def tokens(self, text: str) -> tuple[list[str], list[str]]:
        """Template tokens and the values they stand for."""
        made = self.make(text)
        return [made.token(i) for i in range(len(made))], [made.value(i) for i in range(len(made))]


class _Numbers(dict):
    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.learn(word, number)
        return number


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    last = len(hashes) - width + 1
    rolled = np.zeros(last, dtype=np.uint64)
    for k in range(width):
        rolled = (rolled ^ hashes[k : k + last]) * _MIX
        rolled ^= rolled >> np.uint64(29)
    return rolled


def windows(made: Template, width: int = WIDTH, *, item: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the template's windows with at least half literal words, and of all windows of
    the words as written; for an item, in lower case too."""
    n = len(made)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    width = min(width, n)
    last = n - width + 1
    sums = np.concatenate(([0], np.cumsum(made.slots == 0)))
    ok = np.flatnonzero(2 * (sums[width:] - sums[:last]) >= width)
    every = np.arange(last)
    parts = [(ok, _rolled(made.hashes, width)[ok]), (every, _rolled(made.written, width))]
    if item:
        parts.append((every, _rolled(made.lower, width)))
    return np.concatenate([p for p, _ in parts]), np.concatenate([h for _, h in parts])


def consistent(pairs: list[tuple[str, str, str]]) -> bool:
    """Whether (type, item value, document value) fillings are one to one within each type."""
    there, back = {}, {}
    return all(there.setdefault((k, a), b) == b and back.setdefault((k, b), a) == a for k, a, b in pairs)


class Matcher:
    """Finds items, given as texts, in texts. An item is known by its place in the list."""

    def __init__(self, items: list[str], width: int, coverage: float, cells: int = 20):
        """cells: the log of the size of the table that spares most windows the search."""
        self.width, self.coverage, self.templates = width, coverage, Templates()
        self.items: list[tuple[list[str], list[str]]] = []
        at: dict[int, list[tuple[int, int]]] = {}
        for i, text in enumerate(items):
            made = self.templates.make(text or "")
            where, hashes = windows(made, width, item=True)
            self.items.append(([made.token(k) for k in range(len(made))], [made.value(k) for k in range(len(made))]))
            for p, h in set(zip(where.tolist(), hashes.tolist(), strict=True)):
                at.setdefault(h, []).append((i, p))
        self.at = at
        self.sorted = np.array(sorted(at), dtype=np.uint64)
        self.low = np.uint64((1 << cells) - 1)
        self.maybe = np.zeros(1 << cells, dtype=bool)  # by the low bits
        self.maybe[self.sorted & self.low] = True
        self.widths = {min(width, len(t)) for t, _ in self.items if t}

    def find(self, text: str) -> list[tuple[int, int]]:
        """(place, matched tokens) of the items found."""
        if not len(self.sorted):
            return []
        made = self.templates.make(text)
        diagonals: dict[tuple[int, int], set[int]] = {}
        for width in self.widths:
            where, hashes = windows(made, width) if len(made) >= width else ((), ())
            if not len(where):
                continue
            maybe = self.maybe[hashes & self.low]
            where, hashes = where[maybe], hashes[maybe]
            slot = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            for k in np.flatnonzero(self.sorted[slot] == hashes):
                p = int(where[k])
                for i, q in self.at[int(hashes[k])]:
                    if min(self.width, len(self.items[i][0])) == width:
                        diagonals.setdefault((i, p - q), set()).update(range(q, q + width))
        best: dict[int, int] = {}
        for (i, shift), covered in diagonals.items():
            tokens, values = self.items[i]
            if len(covered) < min(self.coverage * len(tokens), PASSAGE):
                continue
            if consistent([(tokens[q], values[q], made.value(q + shift)) for q in sorted(covered) if tokens[q] in SLOTS]):
                best[i] = max(best.get(i, 0), len(covered))
        return sorted(best.items())


_held: dict[str, object] = {}


def _kept(name: str, make):
    """What ``make`` gives, remembered in this worker until another name is asked for."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def find_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, coverage: float = 0.6) -> DataFrame:
    """id, item id, matched (tokens) and item_tokens for every document and item found in it."""
    found = _find(_bare(docs, id_col, text_col), benchmark, item_col, item_text_col, width, coverage)
    return found.select(F.col("id").alias(id_col), F.col("i").alias(item_col), "matched", "item_tokens")


def _own(id_: Column, text: Column) -> Column:
    """Tells rows without id apart by their texts."""
    return F.when(id_.isNull(), F.xxhash64(text)).otherwise(0)


def _bare(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), _own(F.col(id_col), text).alias("own"), text.alias("text"))


def _find(bare: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, coverage: float = 0.6) -> DataFrame:
    """(id, own, i, matched, item_tokens).

    The items' texts are measured: up to MOST_CHARACTERS they travel to the executors, and a worker makes
    its table of windows once; above, windows meet in a shuffle join. Both give the same rows.
    """
    spark = bare.sparkSession
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    size = items.agg(F.sum(F.length("t") + 1).alias("n")).first()["n"] or 0
    if size > MOST_CHARACTERS:
        return _find_by_shuffle(bare, items, width, coverage)
    rows = items.collect()
    held = spark.sparkContext.broadcast(([r.i for r in rows], [r.t for r in rows]))
    name = uuid.uuid4().hex
    item_type = items.schema["i"].dataType.simpleString()

    def start():
        ids, texts_of_items = held.value
        matcher = _kept(name, lambda: Matcher(texts_of_items, width, coverage))

        def found(texts: list[str]):
            rows = [(k, ids[i], n, len(matcher.items[i][0])) for k, t in enumerate(texts) for i, n in matcher.find(t)]
            at, *columns = zip(*rows) if rows else ((), (), (), ())
            return at, columns

        return found

    return map_rows(bare, ["id", "own"], start, f"i {item_type}, matched long, item_tokens long")


#: Bits of the filter through which documents' windows pass before they are shuffled: for each window of an item, and at most.
BITS, MOST_BITS = 16, 1 << 28
#: A document's candidates are matched in so many lots, so no list of items is long.
LOTS = 16


def _places(h, bits: int):
    """Two places in the filter, of a column or an array of hashes."""
    return (h & (bits - 1), (h >> 20) & (bits - 1)) if isinstance(h, np.ndarray) else (h.bitwiseAND(F.lit(bits - 1)), F.shiftright(h, 20).bitwiseAND(F.lit(bits - 1)))


def _filter(ours: DataFrame) -> np.ndarray:
    """A Bloom filter of the items' hashes, as bytes of 0 and 1 packed into bits; its size follows their number, up to ``MOST_BITS``."""
    n = ours.select("h").distinct().count()
    bits = min(MOST_BITS, 1 << max(10, (BITS * n).bit_length()))
    place = ours.select(F.explode(F.array(*_places(F.col("h"), bits))).alias("p"))
    words = place.groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("v")).toArrow()
    out = np.zeros(bits >> 5, dtype=np.uint32)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().astype(np.uint32)
    return out


def _passes(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), dtype=bool)
    for p in _places(hashes, len(held) << 5):
        out &= (held[p >> 5] >> (p & 31).astype(np.uint32)) & 1 > 0
    return out


def _find_by_shuffle(bare: DataFrame, items: DataFrame, width: int, coverage: float) -> DataFrame:
    """The same for item tables of any size.

    Hashes of the items' windows make a filter that all executors get; documents' windows that pass it meet the items'
    in a shuffle join. Candidates' items are gathered by document, in lots, and meet its text once a lot.
    """

    def hashed(widths: list[int] | None, held=None):
        """(w, h): windows of items, as wide as the item allows, or of documents at each of the items' widths."""

        def start():
            templates = Templates()

            def found(texts: list[str]):
                at, w_, h_ = [], [], []
                for k, t in enumerate(texts):
                    made = templates.make(t)
                    for w in [min(width, len(made))] if widths is None else widths:
                        if 0 < w <= len(made):
                            _, hashes = windows(made, w, item=widths is None)
                            own = np.unique(hashes.view(np.int64))
                            if held is not None:
                                own = own[_passes(held.value, own)]
                            at += [k] * len(own)
                            w_ += [w] * len(own)
                            h_ += own.tolist()
                return at, [w_, h_]

            return found

        return start

    items = staged(items.withColumn("place", F.monotonically_increasing_id()), "decontaminate-texts")
    ours = staged(map_rows(items.select("place", "t"), ["place"], hashed(None), "w int, h long"), "decontaminate-items")
    widths = sorted(r.w for r in ours.select("w").distinct().collect())  # at most ``width`` of them
    passed = bare.sparkSession.sparkContext.broadcast(_filter(ours))
    theirs = map_rows(bare, ["id", "own"], hashed(widths, passed), "w int, h long")
    pairs = theirs.join(ours, ["w", "h"]).select("id", "own", "place").distinct()
    lots = pairs.join(items, "place").groupBy("id", "own", F.pmod("place", F.lit(LOTS)).alias("lot")).agg(F.collect_list(F.struct("i", "t")).alias("items"))
    lots = lots.select(F.col("id").alias("id_"), F.col("own").alias("own_"), "items")
    both = bare.join(lots, F.col("id").eqNullSafe(F.col("id_")) & (F.col("own") == F.col("own_"))).select("id", "own", "text", "items")
    item_type = items.schema["i"].dataType.simpleString()

    def start():
        def found(texts: list[str], items: list[list[dict]]):
            at, columns = [], ([], [], [])
            for k, (text, own) in enumerate(zip(texts, items, strict=True)):
                matcher = Matcher([x["t"] for x in own], width, coverage, cells=10)
                for i, n in matcher.find(text):
                    at.append(k)
                    for c, v in zip(columns, (own[i]["i"], n, len(matcher.items[i][0])), strict=True):
                        c.append(v)
            return at, columns

        return found

    return map_rows(both, ["id", "own"], start, f"i {item_type}, matched long, item_tokens long")


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", **how) -> DataFrame:
    """A row for each row of ``docs``: id, n_items, items (the distinct ids found, sorted; null for items without id), matched
    (tokens), contaminated."""
    bare = _bare(docs, id_col, text_col)
    found = _find(bare, benchmark, item_col, **how)
    ids = F.transform(F.sort_array(F.collect_set(F.struct("i"))), lambda x: x["i"])
    by_doc = found.groupBy("id", "own").agg(ids.alias("items"), F.max("matched").alias("matched"))
    by_doc = by_doc.select(F.col("id").alias("id_"), F.col("own").alias("own_"), "items", "matched")
    out = bare.select("id", "own").join(by_doc, F.col("id").eqNullSafe(F.col("id_")) & (F.col("own") == F.col("own_")), "left")
    items = F.coalesce("items", F.array().cast(by_doc.schema["items"].dataType))
    return out.select(
        F.col("id").alias(id_col),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.coalesce("matched", F.lit(0).cast("long")).alias("matched"),
        (F.size(items) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in which no item is found, columns unchanged. Ids found are counted; few are broadcast."""
    found = _find(_bare(docs, id_col, text_col), benchmark, **how).select("id", "own").distinct()
    found = staged(found, "decontaminate-found")
    rows = packed(docs, key=F.col(id_col), mark=_own(F.col(id_col), text_of(text_col)))
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own"))
    return rows.join(broadcast_if_small(found, found.count()), same, "left_anti").select("row.*")
