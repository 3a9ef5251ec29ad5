"""The name recognizer: decoding against all paths, held-out names, equal weights in every run."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from folioforge.operators import mining
from folioforge.operators import recognize as N


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, length = 5, int(rng.integers(1, 5))
        emit, step = rng.normal(size=(length, n)), rng.normal(size=(n + 1, n)) + N.allowed(n)
        got = N.decode(emit, step)
        score = lambda tags: sum(emit[i, t] + step[tags[i - 1] if i else n, t] for i, t in enumerate(tags))
        best = max(itertools.product(range(n), repeat=length), key=score)
        assert tuple(got) == best


def test_average_is_that_of_all_steps():
    rng = random.Random(2)
    learner = N.Learner(N.blank(("x",)))
    total = np.zeros_like(learner.model.emit)
    words = ["Ann", "saw", "Bob", "run", "the"]
    for _ in range(40):
        tokens = [rng.choice(words) for _ in range(4)]
        learner.see(N.feature_table(tokens), np.array([int(t[0].isupper()) for t in tokens]))
        total += learner.model.emit
    # a sum counts an update from the step after it on
    assert np.allclose(learner.mean().emit, (total - learner.model.emit) / 40 + learner.model.emit / 40)


def made_up(rng, people, places):
    said = [
        "{p} went to {q} with the others.", "In {q} the old man met {p}.", "Nobody told {p} about it.", "They walked from {q} to {r} at night.", "\"Wait,\" said {p}, \"I know.\"",
        "The river was wide and the Boat was new.", "Then it rained for three days.", "Why did {p} leave {q}?", "The city of {q} is far.", "A man called {p} came.",
    ]
    marks, text = [], ""
    for _ in range(rng.randint(3, 8)):
        names = {"p": (rng.choice(people), "person"), "q": (rng.choice(places), "place"), "r": (rng.choice(places), "place")}
        line = rng.choice(said)
        at = 0
        while at < len(line):
            if line[at] == "{":
                name, kind = names[line[at + 1]]
                marks.append((len(text), len(text) + len(name), kind))
                text += name
                at += 3
            else:
                text += line[at]
                at += 1
        text += " "
    return text, marks


def test_names_that_the_glossary_lacks(spark):
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 3))).title()
    people = [name() + (" " + name() if rng.random() < 0.5 else "") for _ in range(60)]
    places = [name() + rng.choice(["ton", "berg", "ville", ""]) for _ in range(60)]
    rows = [(k, made_up(rng, people[:30], places[:30])[0]) for k in range(400)]
    texts = spark.createDataFrame(rows + [(None, None), (9999, "")], "id int, text string").repartition(3)
    glossary = spark.createDataFrame([(t, "person") for t in people[:30]] + [(t, "place") for t in places[:30]] + [(None, "person"), ("", "place")], "term string, kind string")
    model = N.fit(texts, glossary, id_col="id", rounds=3, parts=4)
    again = N.fit(texts.repartition(5), glossary, id_col="id", rounds=3, parts=4)
    assert (model.emit == again.emit).all() and (model.step == again.step).all()
    right = found = real = 0
    for _ in range(150):
        text, marks = made_up(rng, people[30:], places[30:])
        got = {(a, b, k) for _, k, a, b in N.names_in(text, model)}
        right, found, real = right + len(got & set(marks)), found + len(got), real + len(marks)
    precision, recall = right / found, right / real
    assert 2 * precision * recall / (precision + recall) > 0.9, (precision, recall)
    held = spark.createDataFrame([(1, f"Then {people[40]} went to {places[41]} with the others."), (2, None), (3, "")], "id int, text string")
    out = {r.id: r.n for r in held.select("id", N.recognizer(spark, model)(F.col("text")).alias("n")).collect()}
    assert [(x.name, x.kind) for x in out[1]] == [(people[40], "person"), (places[41], "place")] and out[2] is None and out[3] == []
    tokens = mining.tokens(held, "id", "text", "entity", tokenizer=N.name_tokens(spark, model, "place")).collect()
    assert [tuple(r) for r in tokens] == [(1, places[41])]


def test_nothing_to_learn_from(spark):
    empty = N.fit(spark.createDataFrame([], "id int, text string"), spark.createDataFrame([], "term string, kind string"), id_col="id")
    assert N.names_in("Ann went to Rome.", empty) == []


def test_reader_equals_text_by_text(monkeypatch):
    """Names of many texts at a time are those of one after the other, however little is remembered, and sums are equal to the last bit."""
    rng, values = random.Random(4), np.random.default_rng(4)
    model = N.blank(("person", "place"))
    model.emit[:], model.step[:] = values.normal(size=model.emit.shape), values.normal(size=model.step.shape)
    word = lambda: rng.choice(["Ann", "ANN", "saw", "Rome", "x", "^", "$", "7", "l'Été", ".", "!", "\n", "ﬁn"])
    texts = [None, "", " ", *(" ".join(word() for _ in range(rng.choice([1, 5, 60, 700]))) for _ in range(60))]
    want = [None if t is None else N.names_in(t, model) for t in texts]
    for most, tokens in ((200_000, 100_000), (3, 50), (5, 1)):
        monkeypatch.setattr(N.Reader, "MOST", most)
        monkeypatch.setattr(N.Reader, "TOKENS", tokens)
        assert N.Reader(model)(texts) == want
    found = list(N.sentences(texts[-1]))
    seen = []
    reader = N.Reader(model)
    monkeypatch.setattr(reader, "_decode", lambda emit, begin, sizes: seen.append(emit) or [])
    reader.tags(found)
    assert (seen[0] == np.concatenate([model.emit[N.feature_table([t for t, _, _ in s])].sum(axis=1) for s in found])).all()
    assert (reader.table(found)[0] == np.concatenate([N.feature_table([t for t, _, _ in s]) for s in found])).all()


def test_every_text_is_learned_from(spark):
    """a kind whose only name stands in the last of 20,100 texts, in the order of their hash, is learned too."""
    from pyspark.sql import Window

    odd = "Nobody went to Zedton by day."
    last = Window.orderBy(F.desc(F.xxhash64(F.col("id").cast("string"), F.lit(odd))))
    top = spark.range(200_000).select("id", F.row_number().over(last).alias("k")).where("k = 1").select("id", F.lit(odd).alias("text"))
    texts = spark.range(20_100).select((F.col("id") + 200_000).alias("id"), F.lit("Then Ann went home.").alias("text")).union(top)
    glossary = spark.createDataFrame([("Ann", "person"), ("Zedton", "place")], "term string, kind string")
    model = N.fit(texts, glossary, id_col="id", rounds=2)
    assert model.tags[3] == "B-place" and model.emit[:, 3].max() > 0
    assert [(x, k) for x, k, _, _ in N.names_in("Then Ann went home.", model)] == [("Ann", "person")]


def test_sentences_side_by_side_are_those_one_by_one():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sizes = rng.integers(1, 9, 7)
        begin = np.cumsum(sizes) - sizes
        emit, step = rng.normal(size=(int(sizes.sum()), 5)), rng.normal(size=(6, 5)) + N.allowed(5)
        want = np.concatenate([N.decode(emit[a : a + n], step) for a, n in zip(begin, sizes)])
        assert (N.side_by_side(emit, begin, sizes, step) == want).all()
