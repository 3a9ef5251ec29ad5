"""Long lists of replacement rules in few passes over a text.

Rules apply one after the other, so a rule may see what an earlier one wrote. ``layers`` finds which
rules can touch each other: a rule feeds a later one if its replacement can take part in an occurrence of the later
term, or changes whether one at its side stands at a word boundary. Rules that don't feed each other go in
one pass, in which an automaton finds the occurrences of all their terms and an earlier rule's go first
where they overlap; only chains of rules take one pass each link. The result is that of the rules one after the other.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from folioforge.functions.automaton import SLICE, Automaton, is_word, slices, streams, word_bytes


def _contained(parts: list[str], wholes: list[str]) -> list[tuple[int, int, int]]:
    """(whole, part, place) of the parts' occurrences in the wholes."""
    out, data, held = [], [w.encode() for w in wholes], [p.encode() for p in parts]
    for a, b in slices(held):
        found = Automaton(held[a:b])
        for own, starts, stream in streams(data):
            end, part = found.occurrences(stream)
            which = np.searchsorted(starts, end, side="right") - 1
            for k, e, p in zip(which.tolist(), end.tolist(), part.tolist(), strict=True):
                at = len(data[own[k]][: e - len(held[a + p]) - int(starts[k])].decode())
                out.append((own[k], a + p, at))
    return out


class _Most(defaultdict):
    """The largest layer by key; -1 for none."""

    def __init__(self):
        super().__init__(lambda: -1)

    def see(self, key, layer: int) -> None:
        if layer > self.get(key, -1):
            self[key] = layer


def layers(rules: list[tuple[str, str]], boundary: str) -> list[list[int]]:
    """The numbers of the rules by pass. Terms aren't empty.

    For rules j before k: k is in a later pass than j if j feeds k, and in the same or a later one if
    their terms can overlap, or k feeds j. Which rules touch is read off shared beginnings and ends, so no pairs
    are listed but those of which one holds the other.
    """
    begins = {"none": lambda s, at: True, "word": lambda s, at: is_word(s[at - 1]) != is_word(s[at]), "around": lambda s, at: not is_word(s[at - 1])}[boundary]
    ends = {"none": lambda s, at: True, "word": lambda s, at: is_word(s[at - 1]) != is_word(s[at]), "around": lambda s, at: not is_word(s[at])}[boundary]

    def heads(s: str) -> list[str]:
        """Beginnings of ``s``, whole or up to where a term may end."""
        return [s[:n] for n in range(1, len(s)) if ends(s, n)] + [s]

    def tails(s: str) -> list[str]:
        return [s[n:] for n in range(1, len(s)) if begins(s, n)] + [s]

    terms, puts = sorted({t for t, _ in rules}), sorted({p for _, p in rules if p})
    number, put_number = {t: k for k, t in enumerate(terms)}, {p: k for k, p in enumerate(puts)}
    holders, holding, larger, smaller = (defaultdict(set) for _ in range(4))
    for whole, part, at in _contained(terms, puts):  # replacements that hold a term
        p, n = puts[whole], at + len(terms[part])
        if (at == 0 or begins(p, at)) and (n == len(p) or ends(p, n)):
            holders[part].add(whole)
            holding[whole].add(part)
    inside, outside = defaultdict(set), defaultdict(set)
    for whole, part, _ in _contained(puts, terms):  # terms that hold a replacement
        inside[whole].add(part)
        outside[part].add(whole)
    for whole, part, _ in _contained(terms, terms):
        larger[part].add(whole)
        smaller[whole].add(part)

    put_layer, term_layer, fed_tail, fed_head, head, tail = _Most(), _Most(), _Most(), _Most(), _Most(), _Most()
    first_kind, last_kind, left, right = _Most(), _Most(), _Most(), _Most()
    emptied = everything = -1
    out: list[list[int]] = []
    for k, (t, p) in enumerate(rules):
        n, m, first, last = number[t], put_number.get(p), is_word(t[0]), is_word(t[-1])
        moved_left = boundary != "none" and (not p or is_word(p[0]) != first)
        moved_right = boundary != "none" and (not p or is_word(p[-1]) != last)
        feeds = [emptied, *(put_layer.get(x, -1) for x in holders[n] | inside[n])]
        feeds += [fed_tail.get(t[:x], -1) for x in range(1, len(t) + 1)] + [fed_head.get(t[-x:], -1) for x in range(1, len(t) + 1)]
        feeds += [left.get(last, -1), right.get(first, -1)]
        same = [term_layer.get(x, -1) for x in larger[n] | smaller[n]]
        same += [tail.get(x, -1) for x in heads(t)] + [head.get(x, -1) for x in tails(t)]
        if p:
            same += [term_layer.get(x, -1) for x in holding[m] | outside[m]]
            same += [tail.get(x, -1) for x in heads(p)] + [head.get(x, -1) for x in tails(p)]
        else:
            same.append(everything)
        # a term at the side of this one ends in the other kind of character, or in no word character
        side = (lambda own: not own) if boundary == "word" else (lambda own: False)
        if moved_left:
            same.append(last_kind.get(side(first), -1))
        if moved_right:
            same.append(first_kind.get(side(last), -1))
        layer = max(max(feeds) + 1, *same, 0)
        while len(out) <= layer:
            out.append([])
        out[layer].append(k)
        everything = max(everything, layer)
        term_layer.see(n, layer)
        first_kind.see(first, layer)
        last_kind.see(last, layer)
        for x in range(1, len(t) + 1):
            head.see(t[:x], layer)
            tail.see(t[-x:], layer)
        if moved_left:
            left.see(side(first), layer)
        if moved_right:
            right.see(side(last), layer)
        if p:
            put_layer.see(m, layer)
            for x in tails(p):
                fed_tail.see(x, layer)
            for x in heads(p):
                fed_head.see(x, layer)
        else:
            emptied = max(emptied, layer)
    return out


class Rewriter:
    """Applies ordered rules (term, replacement) to texts."""

    def __init__(self, rules: list[tuple[str, str]], boundary: str, order: list[list[int]] | None = None):
        self.boundary = boundary
        self.steps = []
        for layer in layers(rules, boundary) if order is None else order:
            first: dict[bytes, bytes] = {}
            for k in layer:  # of equal terms the first
                first.setdefault(rules[k][0].encode(), rules[k][1].encode())
            terms = list(first)
            parts = [(a, Automaton(terms[a:b])) for a, b in slices(terms, SLICE)]
            self.steps.append((parts, np.array([len(t) for t in terms], dtype=np.int64), list(first.values())))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        out = list(texts)
        for step in self.steps:
            for own, starts, stream in streams(out):
                self._apply(out, own, starts, stream, *step)
        return out

    def _apply(self, out: list[bytes], own: list[int], starts: np.ndarray, stream: bytes, parts, sizes: np.ndarray, puts: list[bytes]) -> None:
        found = [(end, term + a) for a, automaton in parts for end, term in [automaton.occurrences(stream)]]
        end, term = (np.concatenate(x) for x in zip(*found, strict=True))
        start = end - sizes[term]
        if self.boundary != "none" and len(end):
            word = word_bytes(stream)  # of the byte before at its place, of the byte itself one further
            before, begin, last, after = word[start], word[start + 1], word[end], word[end + 1]
            fits = (before != begin) & (last != after) if self.boundary == "word" else ~before & ~after
            start, end, term = start[fits], end[fits], term[fits]
        if not len(end):
            return
        text = np.searchsorted(starts, start, side="right") - 1
        order = np.lexsort((start, term, text))
        start, end, term, text = start[order], end[order], term[order], text[order]
        # an occurrence that overlaps none of its neighbours by place is taken as it is
        by_place = np.lexsort((end, start))
        reach = np.maximum.accumulate(end[by_place])
        apart = np.ones(len(end), dtype=bool)
        apart[by_place[1:]] = start[by_place[1:]] >= reach[:-1]
        free = apart.copy()
        free[by_place[:-1]] &= apart[by_place[1:]]
        taken = free.copy()
        held: set[int] = set()
        for k in np.flatnonzero(~free).tolist():  # in the order of text, rule and place
            span = range(int(start[k]), int(end[k]))
            if held.isdisjoint(span):
                held.update(span)
                taken[k] = True
        kept = np.flatnonzero(taken)
        kept = kept[np.argsort(start[kept], kind="stable")]
        pieces: dict[int, list[bytes]] = {}
        at: dict[int, int] = {}
        for k, a, b, t in zip(text[kept].tolist(), start[kept].tolist(), end[kept].tolist(), term[kept].tolist(), strict=True):
            pieces.setdefault(k, []).extend((stream[at.get(k, int(starts[k])) : a], puts[t]))
            at[k] = b
        for k, own_pieces in pieces.items():
            own_pieces.append(stream[at[k] : int(starts[k]) + len(out[own[k]])])
            out[own[k]] = b"".join(own_pieces)
