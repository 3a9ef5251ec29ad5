"""Small functions without a query of their own."""

from pyspark.sql import functions as F

from folioforge.functions import sequence as Q
from folioforge.functions import text as T
from folioforge.operators import glossary as G
from folioforge.operators import quality as C
from folioforge.sources import files as S
from folioforge.sources import sinks as K


def test_small_text_functions(spark):
    row = spark.createDataFrame([("﻿Tom’s keep\nad here\nkeep", "Tom's", "ab", "Título (solo habrá 1 hoy) fin", "A_B_C")], "t string, p string, s string, n string, m string").select(
        T.strip_bom(F.col("t")).alias("bom"),
        T.strip_possessive(F.col("p")).alias("possessive"),
        T.is_entity(F.col("p")).alias("entity"),
        T.is_entity(F.col("s")).alias("short"),
        T.drop_bracketed_notes(F.col("n"), ["hoy", "solo habr[aá]"]).alias("note"),
        T.drop_lines_with(F.col("t"), "ad here").alias("lines"),
        T.map_segments(F.col("m"), {"B": "X"}).alias("mapped"),
        T.truncate(F.col("p"), 2).alias("cut"),
        T.is_short(F.col("p")).alias("is_short"),
    )
    r = row.first()
    assert (r.bom[0], r.possessive, r.entity, r.short) == ("T", "Tom", True, False)
    assert r.note == "Título fin" and r.lines == "﻿Tom’s keep\nkeep" and (r.mapped, r.cut, r.is_short) == ("A_X_C", "To", True)


def test_lines_know_unicode_line_ends(spark):
    got = spark.createDataFrame([("a\r\nb\x0bc d\n",)], "t string").select(T.lines(F.col("t"))).first()[0]
    assert got == "a\r\nb\x0bc d\n".splitlines()


def test_files_in_a_range(spark, tmp_path):
    for n in (1, 3, 8):
        (tmp_path / f"cn_{n:03d}.txt").write_text("x")
    got = S.numbered_files(S.text_files(spark, str(tmp_path)), low=8, high=2)
    assert sorted(r.number for r in got.collect()) == [3, 8]


def test_json_lines_append(spark, tmp_path):
    one = spark.createDataFrame([(1, "é")], "number int, title string")
    for _ in range(2):
        K.append_json_lines(one, str(tmp_path / "out"))
    assert [r.title for r in spark.read.json(str(tmp_path / "out")).collect()] == ["é", "é"]


def test_spaced_chapter(spark):
    got = spark.range(1).select(K.chapter_text_spaced(F.lit("T"), F.array(F.lit("a"), F.lit("b")))).first()[0]
    assert got == "T\n\n\n\na\n\nb\n"


def test_plural_of_known_terms_is_no_candidate(spark):
    found = spark.createDataFrame([("Old Oaks", 5), ("Old Oak", 5), ("Blue Elm", 3), ("Red Elm", 3), ("Blue Ash", 2), ("Seeing Red", 9), ("The Elm", 9), ("Elm Of", 9), ("Elm Not Blue", 9)], "term string, df long")
    known = spark.createDataFrame([("Old Oak",)], "term string")
    assert [r.term for r in G.candidate_terms(found, known, common=["The"], last=["Of"], indicators=["Not"], first=["Red"]).collect()] == ["Blue Elm"]


def test_no_terms_and_no_rows(spark):
    texts = spark.createDataFrame([], "id int, text string")
    terms = spark.createDataFrame([("a",)], "term string")
    assert C.terms_in(texts, terms, "text", "term").collect() == []
    assert C.terms_in(spark.createDataFrame([(1, None)], "id int, text string"), terms, "text", "term").collect() == []


def test_blocks_end_after_three_empty_ones(spark):
    rows = spark.createDataFrame([(n,) for n in [*range(0, 90), 205, 210, 390, 400]], "n long")
    got = {r.n: r.block for r in Q.range_blocks(rows, "n", 0, 40).collect()}
    assert got == {n: n // 40 for n in [*range(0, 90), 205, 210]}


def test_terms_of_any_length_by_pieces(spark):
    words = ["a", "el", "elm", "oak tree", "New\nline", "ölç", "Old Oak Tree, the", "zz", ""]
    texts = spark.createDataFrame([(1, "the elm tree"), (2, "Old Oak Tree, the oak tree"), (3, "New\nline ölç"), (4, None), (5, "")], "id int, text string")
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    want = {(r[0], w) for r in texts.collect() for w in words if r[1] is not None and w in r[1]}
    many = C.terms_in(texts, terms, "text", "term", slice_bytes=8)
    got = [(r.id, r.term) for r in many.collect()]
    assert set(got) == want == {(r.id, r.term) for r in C.terms_in(texts, terms, "text", "term").collect()} and len(got) == len(want)
    plan = many._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_accents_of_any_script(spark):
    assert spark.range(1).select(T.strip_accents(F.lit("Ñandú й ΐ ἀ é が"))).first()[0] == "Nandu и ι α e か"


def test_ids_beside_nulls_come_back(spark):
    from folioforge.operators import external as X
    from folioforge.sources import html as H

    big = 2**60
    pages = spark.createDataFrame([(big + 1, "<h1>Chapter 3: On</h1>"), (None, "<h1>x</h1>"), (big + 3, None)], "page_id long, html string").coalesce(1)
    got = H.extract_chapters(pages).collect()
    assert [r.page_id for r in got] == [big + 1, None, big + 3] and [r.number for r in got] == [3, None, None]
    assert [r.page_id for r in X.map_model(pages, X.echo, text_col="html").collect()] == [big + 1, None, big + 3]
    named = pages.selectExpr("concat('p', page_id) as page_id", "html")
    assert [r.page_id for r in H.extract_chapters(named).collect()] == [f"p{big + 1}", None, f"p{big + 3}"]
    assert [r.result for r in X.map_model(named, X.echo, text_col="html", prompt_col="page_id").collect()] == [f"[{len(str(big)) + 1}] <h1>Chapter 3: On</h1>", "[0] <h1>x</h1>", None]


def test_alignment_equals_a_walk_over_all_pairs(spark):
    import random

    from folioforge.operators import align as A

    rng = random.Random(4)
    anchors = [("Old", "旧", 200), ("Old", "老", 70), ("Town", "城", 90), ("Oak", "橡", 150), ("Oak", "橡", 10)]
    said = lambda pool: " ".join(rng.choice(pool) for _ in range(rng.randint(0, 3)))
    ours = [(b, n, said(["Old", "Town", "Oak", "x"]) + (" (2)" if rng.random() < 0.2 else "")) for b in "ab" for n in range(1, 60)]
    theirs = [(b, n, said(["旧", "老", "城", "橡", "y"])) for b in "ac" for n in range(1, 45)]
    want = set()
    for book in "a":
        s, t = [r for r in ours if r[0] == book], [r for r in theirs if r[0] == book]
        has = lambda x, y, term, to: term in x and to in y
        scores = {}
        for _, n, x in s:
            for _, m, y in t:
                # as a join on the term gives it: every anchor of the term here with every translation there
                scores[n, m] = sum(w for a, _, w in anchors for b, to, _ in anchors if a == b and has(x, y, a, to))
        split = {n: x.endswith("(2)") for _, n, x in s}
        want |= {(book, n, m) for n, m in A.walk([(n, split[n]) for _, n, _ in s], [n for _, n, _ in t], scores)}
    schema = "book string, number long, text string"
    got = A.align(spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema), spark.createDataFrame(anchors, "term string, translation string, weight int"))
    assert {tuple(r) for r in got.collect()} == want


def test_places_in_an_order(spark):
    import random

    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "b", "é", "zz"]), rng.choice([None, *range(30)]), k) for k in range(400)] + [("hot", k % 40, 1000 + k) for k in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, n int, k int").repartition(5)
    want = sorted(rows, key=lambda r: ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0), r[2]))
    for parts in (1, 4, 32):
        got = {r.k: r.place for r in Q.numbered(df, ["s", "n", "k"], parts).collect()}
        assert got == {r[2]: i for i, r in enumerate(want)}
    assert Q.numbered(df.limit(0), ["s"]).collect() == [] and sorted(r.place for r in Q.numbered(df, ["s"], 3).collect()) == list(range(700))


def test_blocks_that_begin_late_are_dropped(spark):
    rows = spark.createDataFrame([(n,) for n in [500, 510, 900]], "n long")
    assert Q.range_blocks(rows, "n", 0, 100).collect() == []
    assert {r.block for r in Q.range_blocks(rows, "n", 0, 100, 6).collect()} == {5, 9}
    assert {r.n for r in Q.range_blocks(rows, "n", 300, 100).collect()} == {500, 510}


def test_long_books_in_segments(spark):
    """Segments' functions compose to the serial walk, also where anchors throw the pointer off what is expected."""
    import random

    from folioforge.operators import align as A

    rng = random.Random(8)
    anchors = [("Old", "旧", 400), ("Town", "城", 90), ("Oak", "橡", 150)]
    said = lambda pool: " ".join(rng.choice(pool) for _ in range(rng.randint(0, 2)))
    ours = [(b, n, said(["Old", "Town", "Oak", "x"]) + (" (2)" if rng.random() < 0.1 else "")) for b, size in (("a", 300), ("b", 170), ("d", 3)) for n in range(1, size)]
    theirs = [(b, n, said(["旧", "城", "橡", "y", "z"])) for b, size in (("a", 260), ("b", 60), ("c", 9), ("d", 2)) for n in range(1, size)]
    schema = "book string, number long, text string"
    sides = spark.createDataFrame([*ours, (None, 3, "Old"), ("a", None, "Old")], schema), spark.createDataFrame([*theirs, (None, 1, "旧")], schema), spark.createDataFrame(anchors, "term string, translation string, weight int")
    want = sorted(tuple(r) for r in A.align(*sides).collect())
    assert len(want) == 299 + 169 + 2
    assert sorted(tuple(r) for r in A.align(*sides, serial=100, segment=32, band=40, rounds=9).collect()) == want
    assert sorted(tuple(r) for r in A.align(*sides, serial=0, segment=64, band=2, rounds=2).collect()) == want


def test_a_segment_from_every_pointer():
    import numpy as np

    from folioforge.operators import align as A

    numbers = np.arange(1, 400)
    chapters = [(n, n % 9 == 0, {"a": 90} if n % 4 == 0 else {}) for n in range(1, 60)]
    terms = {"a": (np.arange(0, 399, 7), np.ones(57, dtype=np.int64))}
    shared = A.Shared()
    shared.source = {n: h for n, _, h in chapters}
    shared.target = {int(numbers[k]): {"a": 1} for k in range(0, 399, 7)}
    whole = A.run_segment(chapters, numbers, 0, 399, terms, np.arange(399))
    part = A.run_segment(chapters, numbers[50:200], 50, 399, {"a": (terms["a"][0][(terms["a"][0] >= 50) & (terms["a"][0] < 200)] - 50, np.ones(21, dtype=np.int64))}, np.arange(399))
    assert (whole >= 0).all() and whole[0] == int(np.searchsorted(numbers, A.walk([(n, s) for n, s, _ in chapters], numbers.tolist(), shared)[-1][1]))
    assert ((part == whole) | (part == -1)).all() and (part >= 0).sum() > 30


def test_references_cut_short_stay(spark):
    """a heading cut inside a reference reads as the SQL of page_chapters has it."""
    import duckdb

    from folioforge.plans.queries import ORACLE_SQL
    from folioforge.sources import html as H

    rows = [(1, "<h1>Salt &amp;&amp</h1><article><p>" + "a &lt;b&gt; &amp " * 20 + "</p></article>"), (2, "<h1>Chapter 7 &am</h1><article><p>" + "word " * 60 + "&quot</p></article>")]
    found = H.extract_chapters(spark.createDataFrame(rows, "page_id long, html string"), selectors=("article",), whole=True)
    got = found.selectExpr("page_id", "heading", "number", "size(paragraphs)", "array_join(paragraphs, '\n')", "is_short").collect()
    db = duckdb.connect()
    db.execute("create table pages (page_id bigint, html varchar)")
    db.executemany("insert into pages values (?, ?)", rows)
    assert sorted(map(tuple, got)) == sorted(db.execute(ORACLE_SQL["page_chapters"]).fetchall())
    assert H.parse("<h1>a &amp</h1>").text() == "a &" and H.parse("<h1>a &amp</h1>", whole=True).text() == "a &amp"


def test_raw_chapter_works_its_steps_out_once(spark):
    """F8: each step stands once in the plan; null and a file of notes only read as before."""
    rows = [("作者：n\n第1章 A（note x）\n\n one \n第2章 B\n(本章完)\nlater",), ("　a\n2020-01-01",), (None,)]
    out = spark.createDataFrame(rows, "v string").select(S.raw_chapter(F.col("v"), ["note"]).alias("c")).select("c.title", "c.paragraphs")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("本章完") == 1 and plan.count("作者") == 1
    assert [tuple(r) for r in out.collect()] == [("第1章 A", ["one", "第2章 B"]), ("", []), ("", [])]


def test_odd_pages_read_as_the_sql(spark):
    """pages of any build read as the SQL of page_chapters has them."""
    import random

    import duckdb

    from folioforge.plans.queries import ORACLE_SQL
    from folioforge.sources import html as H

    rng = random.Random(5)
    parts = [
        "<h1>", "<H1 class='a'>", "</h1>", "<h2>Chapter 3</h2>", "<h1x>", "<h1é>", "<article>", "<article class=\"chapter\">", "</article>", "</ARTICLE>", "<p>", "<p id=1\n>", "</p>", "<pre>", "</P>", "<br>", "<b>", "</b>", "<!-- <p> -->",
        "<script>var t='</p>';</script>", "<div>", "</div>", "Chapter 12", "chapter\n 9", "CHAPTER 99999999999999999999", "Chapter\u00a04", "&amp;", "&amp", "&lt;", "&amp;lt;", "&quot;", "&#39;", "&#x27;", "&nbsp;", "&copy;", "&copy", "\u00a0", "\u3000",
        "\x0b", "\x85", "\u2028", "\t", "\n", " ", "a", "é", "😀", "word " * 30, "<", ">", "a < b", "<>", "",
    ]
    texts = [None, "", "<p>x</p>", "<h1>A</h1><article><p>one<p>two</p>rest<p></article>", "<h1>l&#39;<i>&Eacute;</i>t\u00e9\u00a0</h1><article><p>a<b>b</b> c&nbsp;d</p>", "<article><h1></h1><p> x </p><p>yz</p></article><article><p>no</p></article>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(700)]
    texts += ["<h1>" + "".join(rng.choice(parts[22:]) for _ in range(4)) + "</h1><article>" + "".join("<p>" + "".join(rng.choice(parts[16:]) for _ in range(6)) + rng.choice(["</p>", ""]) for _ in range(4)) + "</article>" for _ in range(700)]
    rows = list(enumerate(texts))
    found = H.marked_chapters(spark.createDataFrame(rows, "page_id long, html string"))
    got = found.selectExpr("page_id", "heading", "number", "size(paragraphs)", "array_join(paragraphs, '\n')", "is_short").collect()
    db = duckdb.connect()
    db.execute("create table pages (page_id bigint, html varchar)")
    db.executemany("insert into pages values (?, ?)", rows)
    want = {r[0]: r for r in db.execute(ORACLE_SQL["page_chapters"]).fetchall()}
    assert [(texts[r[0]], tuple(r), want[r[0]]) for r in got if tuple(r) != want[r[0]]] == [] and len(got) == len(want)
    assert sum(r[3] > 0 for r in got) > 500
