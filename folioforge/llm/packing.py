"""Vector bin packing of examples into training sequences by the dot-product heuristic.

An example has three sizes: tokens, one segment, and loss-bearing tokens (those after its prompt). A
sequence has a limit for each. Sequences are filled one at a time: of the examples at hand that fit
whole, the one whose sizes have the largest dot product with the room that is left, each as a share of
its limit, goes in; so what a sequence has much of left weighs most. When no example fits whole, the
one with the most tokens left is cut to fill the room, which hits long examples, that can't stay whole
anyway. A sequence that can't be filled, since its segments or loss-bearing tokens are used up or nothing
is left to pack, is cut into sequences whose lengths are powers of two; these need no padding.

Every task packs the examples of its partition, with at most ``POOL`` of them and ``POOL_TOKENS`` tokens (or one
example, if longer) at hand at a time: a map without a shuffle, so a common source or a common text lands nowhere in particular. Rerun
tasks pack alike. ``sequence_id`` holds the partition's number, so it is unique in one plan, and reruns over the same
files agree.

Null and empty texts have the end token alone. Repeated rows are examples of their own; ids of any type,
null too, come back as they went in. An empty table gives no piece. Other columns don't matter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from folioforge.llm.common import ROWS, text_of
from folioforge.llm.token_counts import tokenizer_path

POOL = 2048
POOL_TOKENS = 4_000_000
#: Fixed value: how the word vocabulary's file cuts texts.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Up to here letters, digits and white space are the same in all Unicode versions in use, and texts are in normal form.
_LAST = 0x24F
_PART = 1 << 20


@dataclass(frozen=True)
class Limits:
    """Of a sequence."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, as the tokenizers library gives them.

    Where the vocabulary cuts texts by ``_CUT`` after lower-casing them, a text of common characters
    is cut here and the ids of its words are looked up; words are remembered, for a bounded number of them. All
    other texts, and those that may hold a special token, go to the library. Neither way looks across white space, so long texts
    go part by part.
    """

    MOST = 600_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        held = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (held.get("normalizer") or {}).get("normalizers", [])]
        first, second = ([*((held.get("pre_tokenizer") or {}).get("pretokenizers") or []), {}, {}])[:2]
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": _CUT} and first.get("invert") is True
        self.plain = self.plain and second == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        common = {c for k in range(_LAST + 1) for c in chr(k) + chr(k).lower()}
        kind = {c: unicodedata.category(c)[0] for c in sorted(common)}
        of = lambda k: "".join(re.escape(c) for c, own in kind.items() if own == k)
        white = r"\x09-\x0d\x20\x85\xa0"
        self.words = re.compile(rf"[{of('L')}]+|[{of('N')}]|'(?:[stmd]|re|ve|ll)|[^{white}{of('L')}{of('N')}]+")
        # U+0130 becomes two characters in lower case
        self.odd = re.compile(rf"[^\x00-įı-{chr(_LAST)}]|<\|")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)  # whether a piece ends a word
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.plain = self.plain and held["model"].get("end_of_word_suffix") == "</w>"
        # the model alone, for words that are cut and lower-cased already, their bytes written as the vocabulary writes them
        self.model = Tokenizer.from_str(json.dumps(held | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}})) if self.plain else None
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.bytes = {b: 256 + k for k, b in enumerate(hidden) if b != 32}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the words remembered before these

    def _of(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """A space apart, words are encoded as each is alone."""
        joined = " ".join(words).encode().decode("latin-1").translate(self.bytes)
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        held = ids.tobytes()
        for word, a, b in zip(words, [0, *cuts], cuts, strict=False):
            self.known[word] = held[4 * a : 4 * b]

    def _part(self, text: str) -> bytes:
        if not self.plain or ("<|" in text if text.isascii() else self.odd.search(text)):
            return self._of(text)
        if len(self.known) > self.MOST:
            self.before, self.known = self.known, {}
        words = self.words.findall(text.lower())
        new = set(words).difference(self.known)
        if new:
            old = {w: self.before[w] for w in new if w in self.before}
            self.known |= old
            todo = [w for w in new if w not in old]
            for k in range(0, len(todo), 1000):
                self._learn(todo[k : k + 1000])
        return b"".join(map(self.known.__getitem__, words))

    def __call__(self, text: str) -> bytes:
        if len(text) <= _PART:
            return self._part(text)
        out, at = [], 0
        cut = re.compile(r"[ \n]")
        while at < len(text):
            found = cut.search(text, at + _PART)
            end = found.start() if found else len(text)
            out.append(self._part(text[at:end]))
            at = end
        return b"".join(out)


@lru_cache(maxsize=1)
def ids_of(path: str) -> Ids:
    """One for all tasks of a worker, so words are learnt once."""
    return Ids(path)


@dataclass
class Example:
    """What is left of an example: its ids from ``start`` on. Those from ``prompt`` on bear loss."""

    key: object
    ids: bytes
    prompt: int = 0
    start: int = 0

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4 - self.start

    @property
    def loss(self) -> int:
        return len(self.ids) // 4 - max(self.start, self.prompt)


#: (example, start, length)
Piece = tuple[Example, int, int]


class Packer:
    """Takes examples and gives sequences, each a list of pieces."""

    def __init__(self, limits: Limits, pool: int = POOL, pool_tokens: int = POOL_TOKENS):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits are to be positive")
        self.limits, self.most, self.most_tokens = limits, pool, pool_tokens
        self.held: list[Example | None] = [None] * pool
        self.free = list(range(pool - 1, -1, -1))
        self.tokens, self.loss = np.zeros(pool, dtype=np.int64), np.zeros(pool, dtype=np.int64)
        self.total = 0

    def _put(self, at: int, example: Example | None) -> None:
        self.total -= int(self.tokens[at])
        self.held[at] = example
        self.tokens[at], self.loss[at] = (example.tokens, example.loss) if example else (0, 0)
        self.total += int(self.tokens[at])
        if example is None:
            self.free.append(at)

    def add(self, example: Example) -> Iterator[list[Piece]]:
        if example.tokens:
            self._put(self.free.pop(), example)
        while not self.free or self.total > self.most_tokens:
            yield from self._fill()

    def rest(self) -> Iterator[list[Piece]]:
        while self.total:
            yield from self._fill()

    def choose(self, room: np.ndarray) -> int | None:
        """The place of the example that fits whole with the largest dot product, the first of equals."""
        most = self.limits
        fits = (self.tokens > 0) & (self.tokens <= room[0]) & (self.loss <= room[2])
        if not fits.any():
            return None
        share = room / (most.tokens**2, most.segments**2, most.loss**2)
        product = self.tokens * share[0] + share[1] + self.loss * share[2]
        return int(np.where(fits, product, -1.0).argmax())

    def _fill(self) -> list[list[Piece]]:
        room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], dtype=np.int64)
        out: list[Piece] = []
        while room[0] and room[1] and self.total:
            at = self.choose(room)
            if at is None:
                at = int(self.tokens.argmax())
                example = self.held[at]
                length = int(min(room[0], max(0, example.prompt - example.start) + room[2], example.tokens))
                if not length:
                    break
            else:
                example, length = self.held[at], int(self.tokens[at])
            start = example.start
            out.append((example, start, length))
            room -= (length, 1, max(0, start + length - max(start, example.prompt)))
            left = Example(example.key, example.ids, example.prompt, start + length)
            self._put(at, left if left.tokens else None)
        return [out] if not room[0] else powers_of_two(out)


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces of one sequence as sequences whose lengths are powers of two, the longest first."""
    out, n = [], sum(p[2] for p in pieces)
    todo = pieces[::-1]
    while n:
        size, own = 1 << (n.bit_length() - 1), []
        n -= size
        while size:
            example, start, length = todo.pop()
            if length > size:
                todo.append((example, start + size, length - size))
                length = size
            own.append((example, start, length))
            size -= length
        out.append(own)
    return out


PIECE = "start long, length long, loss_tokens long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(
    examples: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
    limits: Limits = Limits(),
) -> DataFrame:
    """Pieces of the examples: id, start, length, loss_tokens, doc_tokens, sequence_id, offset, ids (little-endian
    unsigned 32-bit). An example's ids are those of its prompt, if it has one, of its text, and ``end_id``."""
    rows = examples.select(F.col(id_col).alias("id"), text_of(prompt_col if prompt_col else F.lit("")).alias("prompt"), text_of(text_col).alias("text"))
    schema = StructType([rows.schema["id"], *StructType.fromDDL(PIECE).fields])
    types = to_arrow_schema(schema)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = ids_of(tokenizer_path(vocabulary)), Packer(limits)
        number = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def write(sequences) -> None:
            nonlocal number
            for pieces in sequences:
                offset = 0
                for e, start, length in pieces:
                    loss = max(0, start + length - max(start, e.prompt))
                    out.append((e.key, start, length, loss, len(e.ids) // 4, number, offset, e.ids[4 * start : 4 * (start + length)]))
                    offset += length
                number += 1

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), types, strict=True)], schema=types)
            out.clear()
            return made

        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                part = whole.slice(k, ROWS)
                for key, prompt, text in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    before = encode(prompt) if prompt else b""
                    write(packer.add(Example(key, before + encode(text) + end, len(before) // 4)))
                if out:
                    yield batch()
        write(packer.rest())
        if out:
            yield batch()

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
