"""Many terms in one pass: by hashes (``Hashed``), or an Aho-Corasick automaton in flat integer arrays, run over UTF-8 bytes.

States and bytes are numbers; bytes that no term has share class 0, which leads to the root. The trie is built
level by level, and each level's rows of the transition table are those of its failure states with its
own children put over them, so the table is a complete automaton. A stream of texts is cut into lanes that
advance together, one gather a step; a lane starts early enough that its state is right where it counts. So the
time depends on the bytes and hardly on the number of terms, and long texts need no care.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

#: Stands between texts; no UTF-8 text has it.
SEPARATOR = b"\xff"
LANES = 2048
#: Bytes of terms that make one automaton: its table has at most so many rows, and 256 columns.
SLICE = 1 << 17
#: Bytes of texts that are looked at together.
STREAM = 1 << 21


class Automaton:
    """Finds all occurrences of distinct, non-empty terms."""

    def __init__(self, terms: list[bytes]):
        self.sizes = np.array([len(t) for t in terms], dtype=np.int64)
        self.longest = int(self.sizes.max(initial=0))
        flat = np.frombuffer(b"".join(terms), dtype=np.uint8)
        used = np.unique(flat)
        self.classes = np.zeros(256, dtype=np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.width = width = len(used) + 1
        starts = np.cumsum(self.sizes) - self.sizes
        # the trie, level by level: children are the distinct (state, class) of the terms that go on
        at, levels, n = np.zeros(len(terms), dtype=np.int64), [], 1
        end = np.zeros(len(terms), dtype=np.int64)
        alive = np.arange(len(terms))
        for depth in range(self.longest):
            alive = alive[self.sizes[alive] > depth]
            key = at[alive] * width + self.classes[flat[starts[alive] + depth]]
            own, which = np.unique(key, return_inverse=True)
            at[alive] = n + which
            levels.append((own // width, own % width, n))
            n += len(own)
            done = alive[self.sizes[alive] == depth + 1]
            end[done] = at[done]
        self.next = np.zeros((n, width), dtype=np.int32)
        fail = np.zeros(n, dtype=np.int32)
        self.term = np.full(n, -1, dtype=np.int32)  # that ends in the state
        self.term[end] = np.arange(len(terms))
        self.link = np.zeros(n, dtype=np.int32)  # the next shorter state in which a term ends
        for parent, kind, first in levels:
            child = np.arange(first, first + len(parent))
            fail[child] = np.where(parent == 0, 0, self.next[parent, kind])
            self.next[parent, kind] = child
            self.link[child] = np.where(self.term[fail[child]] >= 0, fail[child], self.link[fail[child]])
            self.next[child] = self.next[fail[child]]
        self.any = (self.term >= 0) | (self.link > 0)

    def occurrences(self, stream: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(end positions, terms) of all occurrences, in the order of position, longer ones first."""
        n, before = len(stream), max(0, self.longest - 1)
        if not n or not self.longest:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        step = max(-(-n // LANES), 4 * before, 64)
        lanes = -(-n // step)
        kinds = np.zeros(before + lanes * step, dtype=np.int32)
        kinds[before : before + n] = self.classes[np.frombuffer(stream, dtype=np.uint8)]
        view = np.lib.stride_tricks.as_strided(kinds, (before + step, lanes), (kinds.strides[0], step * kinds.strides[0]))
        table, state = self.next.ravel(), np.zeros(lanes, dtype=np.int32)
        ends, states = [], []
        places = np.arange(lanes) * step - before
        for k in range(before + step):
            state = table[state * self.width + view[k]]
            if k >= before:
                hit = self.any[state].nonzero()[0]
                if len(hit):
                    ends.append(places[hit] + k + 1)
                    states.append(state[hit])
        if not ends:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        end, state = np.concatenate(ends), np.concatenate(states)
        all_ends, all_terms = [], []
        while len(end):
            term = self.term[state]
            own = term >= 0
            all_ends.append(end[own])
            all_terms.append(term[own].astype(np.int64))
            state = self.link[state]
            end, state = end[state > 0], state[state > 0]
        end, term = np.concatenate(all_ends), np.concatenate(all_terms)
        order = np.lexsort((-self.sizes[term], end))
        return end[order], term[order]


_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes of terms that are looked for together by hashes, which hold some 40 bytes a term beside them.
LOT = 1 << 23


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashed:
    """As an ``Automaton``, for many terms: memory follows their bytes, and the time hardly their number.

    Hashes of all stretches of a length come from running sums. Those of each term length are looked up among the terms' own,
    behind a filter of bits; from ``LEAST`` bytes on only where a stretch begins like a term. What is found is compared byte by byte.
    """

    LEAST = 4

    def __init__(self, terms: list[bytes]):
        self.sizes = np.array([len(t) for t in terms], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(terms), dtype=np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.power = self.back = np.ones(0, dtype=np.uint64)
        sums = self._sums(self.flat)
        lengths = np.unique(self.sizes)
        self.short, self.long = lengths[lengths < self.LEAST].tolist(), lengths[lengths >= self.LEAST].tolist()
        self.tables = {}
        for size in self.short + self.long:
            own = np.flatnonzero(self.sizes == size)
            found = self._hashes(sums, self.starts[own], size)
            order = np.argsort(found, kind="stable")
            self.tables[size] = (found[order], own[order], self._filter(found))
        if self.long:
            some = np.flatnonzero(self.sizes >= self.LEAST)
            self.begins = self._filter(self._hashes(sums, self.starts[some], self.long[0]))

    def _sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.power) < len(data):
            self.power, self.back = _powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * self.power[: len(data)], out=out[1:])
        return out

    def _hashes(self, sums: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        return (sums[places + size] - sums[places]) * self.back[places] * np.uint64(_MIX)

    @staticmethod
    def _filter(hashes: np.ndarray) -> tuple[np.ndarray, np.uint64]:
        bits = max(10, (16 * len(hashes)).bit_length())
        out, shift = np.zeros(1 << bits, dtype=bool), np.uint64(64 - bits)
        out[hashes >> shift] = True
        return out, shift

    def occurrences(self, stream: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(end positions, terms) of all occurrences, in the order of position, longer ones first."""
        data = np.frombuffer(stream, dtype=np.uint8)
        n, ends, terms = len(data), [], []
        sums = self._sums(data)
        every = np.arange(n)
        near = every
        if self.long:
            near = every[: max(0, n - self.long[0] + 1)]
            held, shift = self.begins
            near = near[held[self._hashes(sums, near, self.long[0]) >> shift]]
        for size, (hashes, own, (held, shift)) in self.tables.items():
            places = near if size >= self.LEAST else every
            places = places[: np.searchsorted(places, n - size, side="right")]
            got = self._hashes(sums, places, size)
            some = held[got >> shift]
            places, got = places[some], got[some]
            at = np.searchsorted(hashes, got)
            while len(at):  # more than once where terms share a hash
                fits = at < len(hashes)
                fits[fits] = hashes[at[fits]] == got[fits]
                places, got, at = places[fits], got[fits], at[fits]
                same = self._equal(data, places, own[at], size)
                ends.append(places[same] + size)
                terms.append(own[at[same]])
                at = at + 1
        if not ends:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        end, term = np.concatenate(ends), np.concatenate(terms)
        order = np.lexsort((-self.sizes[term], end))
        return end[order], term[order]

    def _equal(self, data: np.ndarray, places: np.ndarray, terms: np.ndarray, size: int) -> np.ndarray:
        out, step, offsets = np.zeros(len(places), dtype=bool), max(1, (1 << 20) // size), np.arange(size)
        for k in range(0, len(places), step):
            a, b = places[k : k + step, None] + offsets, self.starts[terms[k : k + step], None] + offsets
            out[k : k + step] = (data[a] == self.flat[b]).all(axis=1)
        return out


def streams(texts: list[bytes], most: int = STREAM) -> Iterable[tuple[list[int], np.ndarray, bytes]]:
    """Texts joined up to about ``most`` bytes at a time: (their numbers, where each starts, the stream)."""
    own, size = [], 0
    for k, text in enumerate(texts):
        own.append(k)
        size += len(text) + 1
        if size >= most:
            yield _joined(texts, own)
            own, size = [], 0
    if own:
        yield _joined(texts, own)


def _joined(texts: list[bytes], own: list[int]) -> tuple[list[int], np.ndarray, bytes]:
    sizes = np.array([len(texts[k]) + 1 for k in own], dtype=np.int64)
    return own, np.cumsum(sizes) - sizes, SEPARATOR.join([texts[k] for k in own])


def slices(terms: list[bytes], most: int = SLICE) -> list[tuple[int, int]]:
    """Ranges of the terms with at most ``most`` bytes each, or one term."""
    out, first, size = [], 0, 0
    for k, term in enumerate(terms):
        if k > first and size + len(term) > most:
            out.append((first, k))
            first, size = k, 0
        size += len(term)
    return [*out, (first, len(terms))] if terms else []


# ---------------------------------------------------------------- word characters, as the JVM's patterns have them


#: Letters that are symbols by category.
_LETTERLIKE = ((0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189))
_KINDS = frozenset("Lu Ll Lt Lm Lo Nl Mn Mc Me Nd Pc".split())


def is_word(c: str) -> bool:
    """Whether ``\\w`` of a Unicode-aware Java pattern takes the character."""
    return unicodedata.category(c) in _KINDS or c in "‌‍" or any(a <= ord(c) <= b for a, b in _LETTERLIKE)


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    return np.fromiter((is_word(chr(c)) for c in range(0x110000)), dtype=bool, count=0x110000)


def word_bytes(stream: bytes) -> np.ndarray:
    """Whether the character that each byte belongs to is a word character, with a False before and after the stream."""
    b = np.frombuffer(stream, dtype=np.uint8)
    out = np.zeros(len(b) + 2, dtype=bool)
    table = _word_table()
    out[1:-1] = table[b] & (b < 0x80)
    lead = np.flatnonzero((b >= 0xC0) & (b < 0xF8))
    if len(lead):
        size = 2 + (b[lead] >= 0xE0) + (b[lead] >= 0xF0)
        code = (b[lead] & (0x7F >> size)).astype(np.int64)
        for k in range(1, 4):
            code = np.where(k < size, (code << 6) | (b[np.minimum(lead + k, len(b) - 1)] & 0x3F), code)
        word = table[np.minimum(code, 0x10FFFF)]
        for k in range(4):
            on = lead[(k < size) & word] + k
            out[on[on < len(b)] + 1] = True
    return out
