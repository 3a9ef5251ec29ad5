"""Tables: votes, mining, alignment, checks, HTML, sinks, models, streaming."""

import io
import math
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from folioforge.operators import align as A
from folioforge.operators import external as X
from folioforge.operators import glossary as G
from folioforge.operators import mining as M
from folioforge.operators import quality as C
from folioforge.sources import files as S
from folioforge.sources import html as H
from folioforge.sources import sinks as K
from folioforge.streaming.resume import process_new_files


def test_vote_tie_goes_to_first(spark):
    rows = spark.createDataFrame([("k", "B", 1, 0), ("k", "A", 2, 0)], "cn string, en string, chapter int, pos int")
    counts = G.pair_counts(rows)
    assert [tuple(r) for r in G.majority_vote(counts).collect()] == [("k", "B")]
    assert {(r.en, r.won) for r in G.vote_conflicts(counts).collect()} == {("B", True), ("A", False)}


def test_inversion(spark):
    edges = spark.createDataFrame([(10, 10), (9, 10), (2, 3)], "en int, cn int")
    assert {r.cn: r["keys"] for r in G.invert_map(edges, "en", "cn").collect()} == {10: [9, 10], 3: [2]}


def test_lift_thresholds(spark):
    def run(n):
        e = [(0, "e"), (1, "e"), (2, "e")]
        w = [(0, "w"), (1, "w")]
        e += [(i, "other") for i in range(3, n)]
        w += [(i, f"x{i}") for i in range(2, n)]
        make = lambda rows, name: spark.createDataFrame(rows, f"k int, {name} string")
        return M.lift(make(e, "entity"), make(w, "word"), "k").collect()

    assert not [r for r in run(10) if r.entity == "e"]
    (got,) = [r for r in run(20) if r.entity == "e"]
    assert got.word == "w" and got.lift == pytest.approx(6.666667, abs=1e-6) and got.score == pytest.approx(4.882721, abs=1e-6)


def test_argmax_comes_before_thresholds(spark):
    e = [(i, "E") for i in range(10)] + [(i, "o") for i in range(10, 100)]
    w = [(i, "W1") for i in range(20)] + [(i, "W2") for i in [0, 1, 2, 3, 50]] + [(i, f"u{i}") for i in range(100)]
    entities, words = spark.createDataFrame(e, "k int, entity string"), spark.createDataFrame(w, "k int, word string")
    assert not [r for r in M.lift(entities, words, "k").collect() if r.entity == "E"]


@pytest.mark.parametrize(("n", "want"), [(1, 1), (201, 100), (203, 102), (1000, 380)])
def test_prediction_rounds_half_even(n, want):
    assert A.predicted(n) == want


def test_alignment_walk(spark):
    assert A.walk([(1, False), (2, True), (3, False)], [1, 2, 3], {}) == [(1, 2), (2, 2), (3, 3)]
    assert A.walk([(1, False)], [7], {}) == [(1, 7)]
    source = spark.createDataFrame([("b", 1, "Old Town"), ("b", 2, "x")], "book string, number long, text string")
    target = spark.createDataFrame([("b", 1, "x"), ("b", 2, "旧城"), ("b", 3, "y")], "book string, number long, text string")
    anchors = spark.createDataFrame([("Old Town", "旧城", 200)], "term string, translation string, weight int")
    assert {tuple(r) for r in A.align(source, target, anchors).collect()} == {("b", 1, 2), ("b", 2, 3)}


def test_missing_translations(spark):
    pairs = spark.createDataFrame([(1, "the Wall and Oak", "nada"), (2, "the Wall", "el Muro"), (3, None, "x")], "id int, en_text string, es_text string")
    master = spark.createDataFrame([("Wall", "Muro"), ("Oak", "Roble")], "en string, es string")
    assert [(r.id, r.en) for r in C.missing_translations(pairs, C.translations_of(master)).collect()] == [(1, "Wall")]


def test_terms_are_the_same_in_many_slices(spark):
    texts = spark.createDataFrame([(1, "see the big old town here"), (2, "xbig old townx"), (3, "big")], "id int, text string")
    terms = spark.createDataFrame([("big old town",), ("big",), ("zz",)], "term string")
    small = {(r.id, r.term) for r in C.terms_in(texts, terms, "text", "term").collect()}
    assert small == {(r.id, r.term) for r in C.terms_in(texts, terms, "text", "term", slice_bytes=3).collect()}
    assert small == {(1, "big old town"), (1, "big"), (2, "big old town"), (2, "big"), (3, "big")}


def test_override_patch(spark):
    master = spark.createDataFrame([("a", "King", "King"), ("b", "Oak", "Oak")], "cn string, en string, es string")
    patch = spark.createDataFrame([("oak", "Roble")], "en string, es string")
    got = {r.cn: (r.es, r.changed, r.suspicious) for r in G.override_patch(master, patch, keywords=["King"]).collect()}
    assert got == {"a": ("King", False, True), "b": ("Roble", True, False)}


def test_shadowed_rules():
    assert G.shadowed_rules([("^S", "x"), ("^St", "y"), ("^M", "z")], ["Stone", "Moon"]) == [1]


def test_html_tree():
    root = H.parse('<body><h2>x</h2><div class="ad">ad</div><article><h1>Chapter 7 <b>Go</b></h1><p>one <i>two</i><p>three<script>"</p>"</script></p><nav>n</nav><p>after</p></article>')
    head = H.find_heading(root)
    assert H.title_and_number(H.squeezed(head.text())) == ("Chapter 7 Go", 7)
    assert H.body(root, head, ()) == ["one two", "three"]
    assert H.body(root, head, ("article",), least=5) == ["one two", "three", "after"]
    assert H.is_ui(H.parse('<div class="reading-content">').find_all("div")[0])
    assert H.find_heading(H.parse("")) is None


def test_epub():
    z = zipfile.ZipFile(io.BytesIO(K.epub_bytes("T & U", "A", [(1, "<One>", ["a < b"])])))
    assert z.namelist()[0] == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED
    assert "&lt;One&gt;" in z.read("OEBPS/chapter_0001.xhtml").decode()


def test_retries_and_passes():
    calls, slept = [], []

    def flaky(system, text):
        calls.append(text)
        if len(calls) < 3:
            raise RuntimeError("429 retry in 12s" if len(calls) == 1 else "boom")
        return text.upper()

    assert X.with_retries(flaky, sleep=slept.append)("", "a") == "A" and slept == [12.0, 2.0]
    assert X.passes((X.echo, ""), (X.echo, "ab"))("s", "t") == "[2] [1] t"

    def broken(system, text):
        raise RuntimeError

    assert X.keep_on_error(broken)("", "t") == "t"


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0001.txt").write_text("T1\n\nbody\n")
    (folder / "0002_draft.txt").write_text("draft\n\nx\n")
    (folder / "0002.txt").write_text("T2\n\ny\n")
    got = S.one_file_a_number(S.text_files(spark, str(folder)))
    assert sorted((r.number, r.name) for r in got.collect()) == [(1, "0001.txt"), (2, "0002.txt")]
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    process_new_files(spark, str(folder), out, mark)
    assert spark.read.parquet(out).count() == 3
    (folder / "0003.txt").write_text("T3\n\nz\n")
    process_new_files(spark, str(folder), out, mark)
    assert sorted(r.number for r in spark.read.parquet(out).collect()) == [1, 2, 2, 3]


def test_json_lines_drop_malformed(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"number": 1, "title": "a"}\n\nbroken\n{"number": 2}\n')
    assert sorted(r.number for r in S.json_lines(spark, str(tmp_path / "i.jsonl"), S.SCRAPE_INDEX).collect()) == [1, 2]


def test_env():
    assert S.read_env('# c\nexport A="x y"\nB=1\nbad\n') == {"A": "x y", "B": "1"}


def test_read_yaml():
    pytest.importorskip("yaml")
    assert S.read_yaml("output:\n  folder: out\nnumbers: [1, 2]\n") == {"output": {"folder": "out"}, "numbers": [1, 2]}
    assert S.read_yaml("# nothing\n") == {}


def plain_lift(entities, words, support=2, lift_above=5.0, confidence_above=0.3):
    """Every entity against every word, by definition."""
    keys = {k for k, _ in entities} & {k for k, _ in words}
    of_e, of_w = {}, {}
    for rows, held in ((entities, of_e), (words, of_w)):
        for k, t in rows:
            if k in keys:
                held.setdefault(t, set()).add(k)
    out = set()
    for entity, a in of_e.items():
        best = None
        for word, b in of_w.items():
            n = len(a & b)
            if len(a) < support or len(b) < support or n < support:
                continue
            confidence, over = n / len(a), (n / len(a)) / (len(b) / len(keys))
            score = round(over * math.log(n + 1) * confidence, 9)
            if best is None or (-score, word) < best[:2]:
                best = (-score, word, n, over, confidence)
        if best and best[3] > lift_above and best[4] > confidence_above:
            out.add((entity, *best[1:3]))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lift_against_all_pairs(spark, seed):
    """Common words that win, lose and tie; entities that stand in few keys and in many."""
    rng = random.Random(seed)
    entities, words = set(), set()
    for k in range(60):
        entities |= {(k, f"e{int(rng.expovariate(0.15))}") for _ in range(4)}
        words |= {(k, f"w{int(rng.expovariate(0.12))}") for _ in range(6)}
        words |= {(k, f"v{e[1:]}") for j, e in entities if j == k and rng.random() < 0.7}
    make = lambda rows, name: spark.createDataFrame(sorted(rows), f"k int, {name} string")
    got = {(r.entity, r.word, r.n) for r in M.lift(make(entities, "entity"), make(words, "word"), "k").collect()}
    assert got and got == plain_lift(entities, words)


def test_tokens_by_an_injected_tokenizer(spark):
    df = spark.createDataFrame([(1, "ab|cd|ab"), (2, None)], "k int, t string")
    got = M.tokens(df, "k", "t", "word", tokenizer=lambda c: F.split(c, r"\|"))
    assert {(r.k, r.word) for r in got.collect()} == {(1, "ab"), (1, "cd")}


def test_long_book_reads_texts_once_a_table_and_keeps_its_pace(spark, monkeypatch):
    """rounds read narrow tables, their tasks run together, and what is left of a book is expected at its pace."""
    from folioforge.operators import align as A

    own = [{"steps": 100, "start": 0, "total": 999, "expected": 0}, {"steps": 100, "start": 150, "total": 999, "expected": 90}, {"steps": 100, "start": None, "total": 999, "expected": 190}]
    A.paced(own, 1)
    assert [x["expected"] for x in own] == [0, 150, 300]
    kept, seen = A._kept, []
    monkeypatch.setattr(A, "_kept", lambda df, name: seen.append((name, df.columns)) or kept(df, name))
    source = spark.createDataFrame([("b", k, "owl" if k % 7 == 0 else "x") for k in range(1, 120)], "book string, number long, text string")
    target = spark.createDataFrame([("b", k, "lechuza" if k % 5 == 0 else "y") for k in range(1, 100)], "book string, number long, text string")
    anchors = spark.createDataFrame([("owl", "lechuza", 200)], "term string, translation string, weight int")
    long = sorted(map(tuple, A.align(source, target, anchors, serial=0, segment=16, band=8).collect()))
    assert {"ours", "theirs", "chapters", "targets", "found"} <= {n for n, _ in seen} and not any("text" in c for _, c in seen)
    assert long == sorted(map(tuple, A.align(source, target, anchors).collect())) and len(long) == 119


def test_lift_sends_no_pairs_and_counts_frequent_entities(spark, monkeypatch):
    """Frequent entities as pairs, all others as arrays in pieces, in a few slices and lots: the same rows."""
    rng = random.Random(7)
    entities, words = set(), set()
    for k in range(80):
        entities |= {(k, f"e{int(rng.expovariate(0.2))}") for _ in range(5)}
        words |= {(k, f"w{int(rng.expovariate(0.1))}") for _ in range(9)}
        words |= {(k, f"v{e[1:]}") for j, e in entities if j == k and rng.random() < 0.7}
    make = lambda rows, name: spark.createDataFrame(sorted(rows), f"k int, {name} string")
    want, real = plain_lift(entities, words), M._counted
    for many, often, piece, slices, lot in ((0, 50, 2, 3, 1), (4, 15, 3, 1, 40), (1_000, 50, 512, 256, 1 << 22)):
        for name, value in {"MANY": many, "OFTEN": often, "PIECE": piece, "SLICES": slices, "LOT": lot}.items():
            monkeypatch.setattr(M, name, value)
        sent = []
        monkeypatch.setattr(M, "_counted", lambda *a, f=real: sent.append(f(*a)) or sent[-1])
        found = M.lift(make(entities, "entity"), make(words, "word"), "k")
        assert {(r.entity, r.word, r.n) for r in found.collect()} == want
        # a key's words travel once a slice: no rows of (entity, word) reach an exchange
        assert "MapInArrow" in sent[0]._jdf.queryExecution().toString() and sent[0].count() <= 2 * len({x for _, x in entities})


def test_slices_that_go_on_in_the_next_batch(spark):
    rows = [(k, "a") for k in range(9)] + [(k, "b") for k in range(9, 16)]
    held = [(k, f"x{k % 2}") for k in range(16)] + [(k, "only b") for k in range(10, 16)] + [(k, f"u{k}") for k in range(16, 60)]
    rows += [(k, "c") for k in range(16, 60)]
    make = lambda rows, name: spark.createDataFrame(rows, f"k int, {name} string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {(r.entity, r.word, r.n) for r in M.lift(make(rows, "entity"), make(held, "word"), "k").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == plain_lift(set(rows), set(held)) and ("b", "only b", 6) in got
