"""Automata against plain search, rules in passes against rules one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from folioforge.functions import automaton as U
from folioforge.functions import replace as R
from folioforge.functions.rewrite import Rewriter, layers
from folioforge.operators import quality as C

PIECES = ["a", "b", " ", ".", "é", "中", "aa", "b a", "<", ">", "́", "𝒳"]


def made(rng, low, high):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(low, high)))


def test_occurrences_are_all_of_them():
    rng = random.Random(1)
    for _ in range(200):
        terms = sorted({made(rng, 1, rng.choice([3, 12])).encode() for _ in range(rng.randint(1, 30))})
        text = made(rng, 0, rng.choice([5, 300, 2000])).encode()
        end, term = U.Automaton(terms).occurrences(text)
        got = sorted((int(e) - len(terms[t]), int(t)) for e, t in zip(end, term, strict=True))
        assert got == sorted((k, n) for n, t in enumerate(terms) for k in range(len(text)) if text.startswith(t, k))


def test_lanes_and_streams(monkeypatch):
    rng = random.Random(2)
    terms = [made(rng, 1, 40).encode() for _ in range(20)]
    texts = [made(rng, 0, 400).encode() for _ in range(60)]
    for lanes, most in ((1, 1), (7, 500), (5000, 1 << 20)):
        monkeypatch.setattr(U, "LANES", lanes)
        found = U.Automaton(sorted(set(terms)))
        got = {}
        for own, starts, stream in U.streams(texts, most):
            for e in found.occurrences(stream)[0].tolist():
                k = int(starts.searchsorted(e)) - 1
                got[own[k]] = got.get(own[k], 0) + 1
        assert got == {k: n for k, t in enumerate(texts) if (n := sum(t.startswith(x, p) for x in set(terms) for p in range(len(t))))}


def one_after_the_other(text, rules, boundary):
    word = U.is_word
    for term, put in rules:
        out, i = "", 0
        while (j := text.find(term, i)) >= 0:
            e = j + len(term)
            before, after = j > 0 and word(text[j - 1]), e < len(text) and word(text[e])
            fits = {"none": True, "word": before != word(term[0]) and word(term[-1]) != after, "around": not before and not after}[boundary]
            out, i = (out + text[i:j] + put, e) if fits else (out + text[i : j + 1], j + 1)
        text = out + text[i:]
    return text


@pytest.mark.parametrize("boundary", ["none", "word", "around"])
def test_passes_equal_rules_in_turn(boundary):
    rng = random.Random(boundary)
    deepest = 0
    for _ in range(700):
        rules = [(made(rng, 1, 4), made(rng, 0 if rng.random() < 0.2 else 1, 4)) for _ in range(rng.choice([2, 4, 9]))]
        if rng.random() < 0.5:
            rules = R.longest_first(rules)
        texts = [made(rng, 0, 30) for _ in range(5)]
        order = layers(rules, boundary)
        deepest = max(deepest, len(order))
        got = Rewriter(rules, boundary, order)([t.encode() for t in texts])
        assert [g.decode() for g in got] == [one_after_the_other(t, rules, boundary) for t in texts], rules
    assert deepest > 2


def test_rules_that_do_not_touch_share_a_pass():
    rules = [(f"word{k:04}", f"<P_{k}>") for k in range(3000)]
    assert len(layers(rules, "word")) == 1
    chain = [(f"link{k}x", f"link{k + 1}x") for k in range(9)]
    assert [len(x) for x in layers(rules + chain, "word")] == [3001] + [1] * 8
    assert [len(x) for x in layers(rules + chain[::-1], "word")] == [3009]  # against the order nothing is fed


@pytest.mark.parametrize("boundary", ["none", "word", "around"])
def test_both_ways_of_replacing_agree(spark, monkeypatch, boundary):
    rng = random.Random(5)
    rules = [(t, made(rng, 0, 3)) for t in {made(rng, 1, 3) for _ in range(60)}][:30]
    rows = spark.createDataFrame([(k, None if k == 3 else made(rng, 0, 40)) for k in range(150)], "id int, t string")
    found = []
    for nested in (0, 1000):
        monkeypatch.setattr(R, "NESTED", nested)
        found.append({r.id: r.x for r in rows.select("id", R.replace_terms(F.col("t"), rules, boundary=boundary).alias("x")).collect()})
    assert found[0] == found[1]


def test_terms_against_contains(spark):
    rng = random.Random(7)
    terms = [made(rng, 0, 6) for _ in range(300)] + [None, "a", "a"]
    texts = [None if k == 4 else made(rng, 0, 60) for k in range(100)]
    left = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    right = spark.createDataFrame([(k, t) for k, t in enumerate(terms)], "n int, term string")
    want = sorted((i, n) for i, x in enumerate(texts) for n, t in enumerate(terms) if x is not None and t is not None and t in x)
    for size in (50, 1 << 17):
        found = C.terms_in(left, right, "text", "term", slice_bytes=size)
        assert found.columns == ["id", "text", "n", "term"]
        assert sorted((r.id, r.n) for r in found.collect()) == want


def test_hashes_find_what_automata_find(monkeypatch):
    """many terms in memory that follows their bytes, also where all hashes are the same."""
    rng = random.Random(3)
    for k in range(120):
        terms = sorted({made(rng, 1, rng.choice([3, 12])).encode() for _ in range(rng.randint(0, 30))})
        text = made(rng, 0, rng.choice([5, 300, 2000])).encode()
        if k == 100:
            monkeypatch.setattr(U, "_MIX", 0)
        assert [x.tolist() for x in U.Hashed(terms).occurrences(text)] == [x.tolist() for x in U.Automaton(terms).occurrences(text)]
    monkeypatch.undo()
    many = sorted({rng.randbytes(rng.randint(7, 20)).hex().encode() for _ in range(50_000)})
    held = U.Hashed(many)
    size = sum(a.nbytes for a in [held.flat, held.sizes, held.starts, held.power, held.back, held.begins[0], *(x for h, o, f in held.tables.values() for x in (h, o, f[0]))])
    assert size < 40_000_000  # automata over them have 250,000 states a slice and 17 columns each: over 90 MB


def test_lots_of_texts_follow_bytes():
    import pyarrow as pa

    from folioforge.functions import replace as R

    texts = pa.array(["a" * 40, None, "", "é" * 30, "b" * 200, None, "c"])
    lots = list(R._lots(texts, 100))
    assert pa.concat_arrays(lots).equals(texts) and [len(x) for x in lots] == [4, 1, 2]
    assert all(len(x) == 1 or sum(len((t or "").encode()) for t in x.to_pylist()) <= 100 for x in lots)
    assert [len(x) for x in R._lots(texts.slice(3), 100)] == [1, 1, 2] and not list(R._lots(texts.slice(7)))
