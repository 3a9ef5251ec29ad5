"""Decontamination against a plain version, on both paths; items that share an id or have none."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import decontaminate as D

TEMPLATES = D.Templates()


def plain_windows(text, width):
    """(place, kind, window) of literal-rich template windows and of the words as written."""
    made = TEMPLATES.make(text or "")
    n = len(made)
    token, raw = [made.token(k) for k in range(n)], [made.words[made.kept[k]] for k in range(n)]
    width = min(width, n)
    out = []
    for k in range(n - width + 1 if n else 0):
        if 2 * sum(not t.startswith("<") for t in token[k : k + width]) >= width:
            out.append((k, ("template", *(t for t in token[k : k + width]))))
        out.append((k, ("written", *raw[k : k + width])))
    return made, width, out


def plain_find(text, items, width=D.WIDTH, coverage=0.6):
    """(place, matched tokens) of the items found, every window of one held against every window of the other."""
    out = []
    for place, item in enumerate(items):
        made, size, own = plain_windows(item, width)
        if not size:
            continue
        own = {*own, *((k, ("written", *(made.words[made.kept[j]].lower() for j in range(k, k + size)))) for k, _ in own)}
        doc, at_most, theirs = plain_windows(text, size)
        if at_most < size:
            continue
        covered = {}
        for p, a in theirs:
            for q, b in own:
                # a window of words may equal one of a template: both are hashes of words
                if a[1:] == b[1:]:
                    covered.setdefault(p - q, set()).update(range(q, q + size))
        best = 0
        for shift, tokens in covered.items():
            slots = [(made.token(q), made.value(q), doc.value(q + shift)) for q in sorted(tokens) if made.slots[q]]
            if len(tokens) >= min(coverage * len(made), D.PASSAGE) and D.consistent(slots):
                best = max(best, len(tokens))
        if best:
            out.append((place, best))
    return out


def made_up(seed):
    rng = random.Random(seed)
    pool = ["tree", "stone", "ran", "to", "the", "old", "Anna", "Ben", "12", "7", "40", "km", "hours", "river", "und", "Vogel", "."]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [text(rng.choice([1, 2, 5, 9, 20, 60])) for _ in range(14)]
    docs = []
    for _ in range(60):
        parts = [text(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(items).split()
            a = rng.randint(0, len(words) // 2)
            words = [("Carl" if w == "Anna" else "99" if w == "12" else w) if rng.random() < 0.7 else w for w in words[a:]]
            parts += [" ".join(words), text(rng.randint(0, 9))]
        joined = " ".join(parts)
        docs.append(joined.lower() if rng.random() < 0.2 else joined)
    return items, docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matcher_against_plain(seed):
    items, docs = made_up(seed)
    matcher = D.Matcher(items, D.WIDTH, 0.6)
    want = [plain_find(t, items) for t in docs]
    assert [matcher.find(t) for t in docs] == want and sum(map(len, want)) > 20


@pytest.mark.parametrize("most", [D.MOST_CHARACTERS, -1])
def test_both_paths_against_plain(documents, spark, monkeypatch, most):
    """Items: ids that repeat, that are null, that tie; texts that repeat, are null or empty."""
    monkeypatch.setattr(D, "MOST_CHARACTERS", most)
    items, docs = made_up(4)
    ids = [None, None, 5, 5, 5, 7, 8, None, 9, 10, 11, 12, 13, 13]
    table = [*zip(ids, items), (20, items[3]), (None, items[3]), (21, None), (22, ""), (None, None)]
    rows = list(enumerate(docs)) + [(900, docs[0]), (900, docs[0]), (None, docs[1]), (None, docs[2]), (901, None), (902, "")]
    got = D.contamination(documents(rows).withColumn("items", F.lit(1)).withColumn("place", F.lit(1)), spark.createDataFrame(table, "item_id long, text string")).collect()

    def want(text):
        hits = plain_find(text or "", [t for _, t in table])
        found = {table[k][0] for k, _ in hits}
        return sorted(found, key=lambda i: (i is not None, i)), max((n for _, n in hits), default=0)

    expected = [(i, len(w[0]), w[0], w[1], bool(w[0])) for i, t in rows for w in [want(t)]]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("most", [D.MOST_CHARACTERS, -1])
@pytest.mark.parametrize("order", [1, -1])
def test_two_items_under_one_id(documents, spark, prose, monkeypatch, most, order):
    monkeypatch.setattr(D, "MOST_CHARACTERS", most)
    long, short = prose(60, 1), prose(9, 2)
    for i in (None, 3):
        items = spark.createDataFrame([(i, long), (i, short)][::order], "item_id long, text string").coalesce(1)
        got = {r.doc_id: (r.n_items, r["items"], r.contaminated) for r in D.contamination(documents([(1, f"x y {long}"), (2, f"{short} z"), (3, prose(50, 3))]), items).collect()}
        assert got == {1: (1, [i], True), 2: (1, [i], True), 3: (0, [], False)}
        assert [r.doc_id for r in D.clean(documents([(1, long), (2, short), (3, prose(50, 3))]), items).collect()] == [3]


def test_filter_passes_what_it_holds(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-(2**63), 2**63 - 1, 5000)
    held = D._filter(spark.createDataFrame([(int(x),) for x in h], "h long"))
    assert D._passes(held, h).all()
    assert D._passes(held, rng.integers(-(2**63), 2**63 - 1, 50_000)).mean() < 0.05
