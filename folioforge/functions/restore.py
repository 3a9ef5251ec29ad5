"""Damaged placeholder names against large tables of tokens: exact, by beginning, by shared segments.

The ordered rules take, for the forms of a name in their order, the first token equal to one; then the first token in
the table that begins with one; then the token that shares most segments with it. Each has an index, so a look-up
reads a few entries of the table: a dictionary; the sorted tokens with the least place of any stretch of them; and
lists of tokens by segment, of which only as many need be read, rare ones first, as could hold no token that passes
the threshold if they were left out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def segments_of(token: str) -> frozenset[str]:
    """The segments of a token, <PROTECT_...>, without its number."""
    return frozenset(re.sub(r"_\d+$", "", token[9:-1]).split("_")) - {""}


class Restorer:
    """Looks names up in (token, term) pairs; of equals the first."""

    def __init__(self, restore: list[tuple[str, str]], threshold: float):
        self.terms, self.threshold = [t for _, t in restore], threshold
        self.exact: dict[str, str] = {}
        for token, term in restore:
            self.exact.setdefault(token, term)
        order = sorted(range(len(restore)), key=lambda k: restore[k][0])
        self.sorted = [restore[k][0] for k in order]
        # least[h][k]: the least place in the table of the 2^h sorted tokens from k on
        self.least = [np.array(order, dtype=np.int64)]
        while 2 << (len(self.least) - 1) <= len(order):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))
        self.segments = [segments_of(token) for token, _ in restore]
        self.by_segment: dict[str, list[int]] = {}
        for k, own in enumerate(self.segments):
            for s in own:
                self.by_segment.setdefault(s, []).append(k)

    def begins(self, start: str) -> int | None:
        """The first place of a token that begins with ``start``."""
        low = bisect_left(self.sorted, start)
        high = bisect_left(self.sorted, start + "\U0010ffff\U0010ffff")
        if low >= high:
            return None
        h = (high - low).bit_length() - 1
        return int(min(self.least[h][low], self.least[h][high - (1 << h)]))

    def closest(self, words: frozenset[str]) -> int | None:
        """The first of the tokens that share most of the larger side's segments, if enough."""
        need = max(1, math.ceil(self.threshold * len(words) - 1e-9))
        lists = sorted((self.by_segment.get(s, []) for s in words), key=len)
        some = {k for own in lists[: len(lists) - need + 1] for k in own}
        best, at = 0.0, None
        for k in some:
            held = self.segments[k]
            if self.threshold * len(held) <= len(words) + 1e-9:  # else it shares too few
                share = len(words & held) / max(len(words), len(held), 1)
                if share > best or share == best and at is not None and k < at:
                    best, at = share, k
        return at if best >= self.threshold else None

    def __call__(self, names: list[str], bare: list[str]) -> str | None:
        """names: the name's slug, its mapped form, and it without its number; bare: these without numbers."""
        raw, mapped, base = names
        forms = [raw, mapped if mapped != raw else None, base if base not in ("", raw) else None]
        tries = [f"<PROTECT_{f}>" for f in forms if f is not None]
        for t in tries:
            if t in self.exact:
                return self.exact[t]
        first = [k for t in tries if (k := self.begins(re.sub(">+$", "", t))) is not None]
        if first:
            return self.terms[min(first)]
        for name, own in zip(names, bare, strict=True):
            if name:
                k = self.closest(frozenset(own.split("_")) - {""})
                if k is not None:
                    return self.terms[k]
        return None


def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(start, ord): the least ord of the tokens that begin with each start, of one range of the starts and tokens (s, ord) in order; a start has no ord.

    Starts that the last string begins with are the only ones open. One that a former range left open begins this range's first token, if
    any of its tokens: so for each beginning of that one there is a row too, with the least ord of the tokens that share it.
    """
    schema = pa.schema([("start", pa.string()), ("ord", pa.int64())])
    open_starts: list[list] = []
    head, least, shared = None, {}, 0
    made: list[tuple[str, int]] = []

    def close() -> None:
        start, own = open_starts.pop()
        if own is not None:
            made.append((start, own))
            if open_starts and (open_starts[-1][1] is None or own < open_starts[-1][1]):
                open_starts[-1][1] = own

    for batch in batches:
        for s, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            while open_starts and not s.startswith(open_starts[-1][0]):
                close()
            if place is None:
                open_starts.append([s, None])
                continue
            if open_starts and (open_starts[-1][1] is None or place < open_starts[-1][1]):
                open_starts[-1][1] = place
            if head is None:
                head, shared = s, len(s)
            while not s.startswith(head[:shared]):
                shared -= 1
            least[shared] = min(place, least.get(shared, place))
        if made:
            yield pa.RecordBatch.from_pylist([{"start": a, "ord": b} for a, b in made], schema=schema)
            made.clear()
    while open_starts:
        close()
    own = None
    for n in range(len(head or ""), 0, -1):
        own = min((x for x in (own, least.get(n)) if x is not None), default=None)
        if own is not None:
            made.append((head[:n], own))
    yield pa.RecordBatch.from_pylist([{"start": a, "ord": b} for a, b in made], schema=schema)
