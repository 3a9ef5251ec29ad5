"""Segmentation against a plain dynamic programme."""

import math
import random

from pyspark.sql import functions as F

from folioforge.operators import mining
from folioforge.operators.segment import Lexicon, Segmenter, lexicon, segmenter

WORDS = {"the": 50, "there": 9, "rein": 3, "re": 2, "in": 30, "he": 11, "river": 4, "中": 7, "中国": 9, "国人": 3, "人": 8, "é": 1, "été": 4}


def plain(run, held):
    """The most probable path, every substring tried as a word."""
    best = [(0.0, [])]
    for j in range(1, len(run) + 1):
        found = []
        for i in range(j):
            word = run[i:j]
            for score in (held.words.get(word, -math.inf), held.unknown(word)):
                found.append((best[i][0] + score, [*best[i][1], word]))
        best.append(max(found, key=lambda f: f[0]))
    return best[-1]


def score(words, held):
    return sum(max(held.words.get(w, -math.inf), held.unknown(w)) for w in words)


def test_paths_are_the_best():
    rng = random.Random(1)
    for n in range(300):
        held = Lexicon({w: c for w, c in WORDS.items() if rng.random() < 0.8}) if n else Lexicon({})
        run = "".join(rng.choice([*WORDS, "x", "qz", "t", "国"]) for _ in range(rng.randint(1, 8)))
        got = Segmenter(held)([run])[0]
        assert "".join(got) == run
        assert math.isclose(score(got, held), plain(run, held)[0], rel_tol=1e-9), (run, got)


def test_words_and_unknown_runs(spark):
    held = lexicon(spark.createDataFrame([(w, n - 1) for w, n in WORDS.items()] + [(w, 1) for w in WORDS] + [("", 9), (None, 3), ("zero", 0)], "word string, n long"))
    assert held.words == Lexicon(WORDS).words
    rows = spark.createDataFrame([(1, "theriver, inthere 12 中国人"), (2, None), (3, ""), (4, "qqzzqqzz the_river"), (5, "the " * 4000)], "id int, t string")
    got = {r.id: r.w for r in rows.select("id", segmenter(spark, held)(F.col("t")).alias("w")).collect()}
    assert got[1] == ["the", "river", "in", "there", "中国", "人"] and got[2] is None and got[3] == []
    assert got[4] == ["qqzzqqzz", "the", "river"] and got[5] == ["the"] * 4000


def test_lift_takes_segmented_words(spark):
    held = Lexicon(WORDS)
    pairs = spark.createDataFrame([(k, "中国人" if k < 4 else "人", "China here" if k < 4 else "other") for k in range(40)], "k int, cn string, en string")
    words = mining.tokens(pairs, "k", "cn", "entity", tokenizer=segmenter(spark, held))
    found = mining.lift(words, mining.tokens(pairs, "k", "en", "word"), "k").collect()
    assert {r.entity: r.word for r in found} == {"中国": "China"}


def test_what_a_task_remembers_is_bounded(monkeypatch):
    """by characters, as runs may be long; words are the same."""
    from folioforge.operators import segment as N

    held = N.Lexicon({"ab": 3, "cd": 2, "abcd": 1, "e": 5})
    texts = [["abcde" * (k + 1)] for k in range(40)]
    plain = [N.Segmenter(held)(t) for t in texts]
    monkeypatch.setattr(N, "REMEMBERED", 300)
    cut = N.Segmenter(held)
    for own, want in zip(texts, plain, strict=True):
        assert cut(own) == want
        assert sum(map(len, cut.remembered)) <= 300
