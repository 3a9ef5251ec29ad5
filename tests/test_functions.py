"""Golden cases of the scalar, replacement and sequence functions."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import replace as R
from folioforge.functions import sequence as Q
from folioforge.functions import text as T
from folioforge.sources import files as S


def one(spark, column, **values):
    row = [tuple(values.values())] if values else [(0,)]
    names = list(values) or ["x"]
    types = ", ".join(f"{n} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for n, v in zip(names, row[0]))
    return spark.createDataFrame(row, types).select(column).first()[0]


@pytest.mark.parametrize(("text", "slug"), [("  Old-Town (North) ", "OLD_TOWN_NORTH"), ("苏宇", ""), ("a" * 50, "A" * 40)])
def test_slugify(spark, text, slug):
    assert one(spark, T.slugify(F.col("t")), t=text) == slug


def test_chapter_scan(spark):
    got = one(spark, S.chapter(F.col("t")), t="Title  \nDROPPED\npara a1\n a2 \n\n\npara b\n")
    assert (got.title, got.paragraphs) == ("Title", ["para a1  a2", "para b"])
    empty = one(spark, S.chapter(F.col("t")), t="")
    assert (empty.title, empty.paragraphs) == ("", [])


def test_chunking(spark):
    lengths = F.array(*(F.lit(n) for n in (4, 3, 2, 12, 1)))
    assert one(spark, Q.chunk_ids(lengths, 10, 2)) == [0, 1, 1, 2, 3]
    assert one(spark, Q.chunk_ids(lengths, 10, 0)) == [0, 0, 0, 1, 2]
    got = one(spark, Q.chunks(F.col("p"), 10, 2), p=["aaaa", "bbb", "cc", "d" * 12, "e"])
    assert got == [["aaaa"], ["bbb", "cc"], ["d" * 12], ["e"]]
    assert one(spark, Q.chunks(F.col("p"), 10), p=[]) == []


def test_placeholders(spark):
    terms = spark.createDataFrame([(1, "Old Town"), (2, "Old-Town"), (3, "苏")], "ord int, term string")
    got = {r.term: (r.token, r.alias) for r in R.placeholders(terms).collect()}
    assert got == {
        "Old Town": ("<PROTECT_OLD_TOWN_1>", "<PROTECT_OLD_TOWN>"),
        "Old-Town": ("<PROTECT_OLD_TOWN_2>", None),
        "苏": ("<PROTECT__1>", "<PROTECT_>"),
    }
    known = spark.createDataFrame([("<PROTECT_OLD_TOWN_1>", "X"), ("<PROTECT_OLD_TOWN>", "X")], "token string, term string")
    first = R.placeholders(terms.where("ord = 1"), known).first()
    assert (first.token, first.alias) == ("<PROTECT_OLD_TOWN_2>", None)
    known = spark.createDataFrame([(0, "<PROTECT_OLD_TOWN_2>", "X"), (1, "<PROTECT_SEA_7>", "Sea"), (2, "<PROTECT_SEA_3>", "See")], "ord int, token string, term string")
    made = R.placeholders(terms, known)
    got = {r.term: (r.token, r.alias) for r in made.collect()}
    assert got["Old Town"] == ("<PROTECT_OLD_TOWN_1>", "<PROTECT_OLD_TOWN>") and got["Old-Town"] == ("<PROTECT_OLD_TOWN_3>", None)
    assert [tuple(r) for r in R.known_aliases(known, made).collect()] == [("<PROTECT_SEA>", "Sea")]


def test_protect_longest_first(spark):
    rules = [("War Academy", "<W>"), ("Great War Academy", "<G>")]
    got = one(spark, R.replace_terms(F.col("t"), rules), t="War Academy and Great War Academy, preWar Academy")
    assert got == "<W> and <G>, preWar Academy"


def test_boundaries_differ_at_punctuation(spark):
    assert one(spark, R.replace_terms(F.col("t"), [("Mr.", "Z")], boundary="around"), t="Mr. x Mr.y") == "Z x Mr.y"
    assert one(spark, R.replace_terms(F.col("t"), [("Mr.", "Z")]), t="Mr. x Mr.y") == "Mr. x Zy"


def test_replacement_text_is_literal(spark):
    assert one(spark, R.replace_terms(F.col("t"), [("a.b", r"$1\x")]), t="see a.b, axb") == r"see $1\x, axb"


@pytest.mark.parametrize(
    ("name", "term"),
    [("great old queen", "Great Old King"), ("great", "Great Old King"), ("苏", "Great Old King"), ("River_9", "River"), ("nothing like", None)],
)
def test_placeholder_lookup(spark, name, term):
    restore = [("<PROTECT_GREAT_OLD_KING_1>", "Great Old King"), ("<PROTECT_RIVER_1>", "River")]
    assert one(spark, R.lookup_placeholder(F.col("n"), restore), n=name) == term


def test_restore_damaged(spark):
    restore = [("<PROTECT_OLD_TOWN_1>", "Old Town")]
    df = spark.createDataFrame([(1, "a < protect : Old Town > b PROTECT_OLD_TOWN_1 c <PROTECT_ZZ> <PROTECT_OLD_TOWN_1>"), (2, None)], "id int, t string")
    got = {r.id: r.t for r in R.restore_all(df, "t", "id", restore).collect()}
    assert got == {1: "a Old Town b Old Town c <PROTECT_ZZ> Old Town", 2: None}


def test_restore_damaged_moves_no_text(spark):
    restore = [("<PROTECT_OLD_TOWN_1>", "Old Town"), ("<PROTECT_OLD_TOWN_WALL_1>", "Old Town Wall")]
    df = spark.createDataFrame([(1, "< PROTECT: old town wall >"), (1, "<PROTECT_old_town> <PROTECT_old_town>"), (None, "none"), (2, "")], "id int, t string")
    out = R.restore_all(df, "t", "id", restore)
    assert sorted(r.t for r in out.collect()) == ["", "Old Town Old Town", "Old Town Wall", "none"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_rotation_keeps_last(spark):
    got = one(spark, R.rotate_phrases(F.col("t"), [("foo", ["uno", "Dos"])]), t="a foo b Foo c foo d foo e")
    assert got == "a uno b Dos c uno d foo e"
    assert one(spark, R.rotate_phrases(F.col("t"), [("foo", ["uno"])]), t="one foo") == "one foo"


def test_merge_one_word(spark):
    words = ["No", "Boom", "Puf", "Sí"]
    got = one(spark, Q.merge_one_word(F.col("p"), words), p=["¡No!", "¡Sí!", "Hola.", "¡Boom!", "¡Puf!", "Fin."])
    assert got == ["¡No! —¡Sí!", "Hola. —¡Boom! —¡Puf!", "Fin."]
    assert one(spark, Q.merge_one_word(F.col("p"), words), p=["Hola.", "", "Boom!"]) == ["Hola.", " —¡Boom!"]


def test_ellipsis(spark):
    got = one(spark, T.drop_ellipsis_paragraphs(F.col("t")), t="...\n\n……\n\n…\n\na")
    assert got == "……\n\n…\n\na"


def test_split_marker(spark):
    assert [one(spark, T.is_split_part(F.col("t")), t=x) for x in ("Part (2)", "Part (1)", "Part (10)")] == [True, False, False]


def test_numbered_title(spark):
    f = lambda t, n="x": tuple(one(spark, T.numbered_title(F.col("t"), F.col("n")), t=t, n=n))
    assert f("Capítulo 12: Foo") == (12, "Foo")
    assert f("capitulo 7") == (7, "Capítulo 7")
    assert f("none", "cn_0044_es.txt") == (44, "Capítulo 44")
    assert f("none", "none") == (None, None)


def test_json_in_text(spark):
    assert one(spark, T.json_in_text(F.col("t")), t='```json\n{"a":"x","b":1}\n```') == {"a": "x"}
    assert one(spark, T.json_in_text(F.col("t")), t="none") is None


def test_leaked_names(spark):
    names = [("Big Oak", "Gran R"), ("Oak", "R")]
    assert one(spark, R.fix_leaked(F.col("t"), names, apply=False), t="Big Oak and Oak").fixes == 3
    got = one(spark, R.fix_leaked(F.col("t"), names), t="Big Oak and Oak")
    assert (got.text, got.fixes) == ("Gran R and R", 2)


def test_ui_block(spark):
    assert one(spark, T.is_ui_block(F.lit("div"), F.lit("reading-content")))
    assert not one(spark, T.is_ui_block(F.lit("div"), F.lit("body")))


def test_blocks(spark):
    df = spark.createDataFrame([(1,), (2,), (5,), (9,)], "n int")
    assert {r.n: r.block for r in Q.fixed_blocks(df, ["n"], 2).collect()} == {1: 0, 2: 0, 5: 1, 9: 1}
    assert {r.n: r.block for r in Q.range_blocks(df, "n", 1, 4).collect()} == {1: 0, 2: 0, 5: 1, 9: 2}
    far = spark.createDataFrame([(1,), (50,)], "n int")
    assert [r.n for r in Q.range_blocks(far, "n", 1, 4).collect()] == [1]


def test_raw_chapter(spark):
    text = "2020-01-01 x\n作者：n\n　note\n第3章 名（求月票啊）\n正文\n第4章 再\n（本章完）\nafter"
    got = one(spark, S.raw_chapter(F.col("t"), ["求月", "note"]), t=text)
    assert (got.title, got.paragraphs) == ("第3章 名", ["正文", "第4章 再"])
    assert one(spark, S.raw_chapter(F.col("t")), t=text).title == "第3章 名（求月票啊）"


def test_masking(spark):
    masked = one(spark, R.mask_terms(F.col("t"), ["ab", "abc"]), t="abc ab")
    assert masked == "X0X X1X"
    assert one(spark, R.unmask_terms(F.col("t"), ["ab", "abc"], {"abc": "q$"}), t="x 0 X X1X") == "q$ ab"


def test_keyword_contexts(spark):
    got = one(spark, T.keyword_contexts(F.col("t"), "key", width=3), t="abcKEYdef\nkey key key")
    assert got.n == 4 and got.contexts == ["abcKEYdef", "ef key ke", "ey key ke"]


def test_null_and_empty_texts(spark):
    for value in (None, ""):
        df = spark.createDataFrame([(value,)], "t string")
        df.select(T.slugify(F.col("t")), T.cleanup_paragraph(F.col("t")), S.chapter(F.col("t")), R.rotate_phrases(F.col("t"), [("a", ["b"])]), T.keyword_contexts(F.col("t"), "a"), S.raw_chapter(F.col("t")), T.split_paragraphs(F.col("t"))).collect()


def test_many_rules_and_phrases_keep_the_plan_flat(spark):
    rules = [(f"term{i}", f"T{i}") for i in range(400)]
    text = "term7 term399 xterm1 term39"
    for boundary, want in (("word", "T7 T399 xterm1 T39"), ("around", "T7 T399 xterm1 T39"), ("none", "T7 T399 xT1 T39")):
        assert one(spark, R.replace_terms(F.col("t"), rules, boundary=boundary), t=text) == want
    assert one(spark, R.fix_leaked(F.col("t"), rules), t=text).fixes == 4
    phrases = [(f"uno {i}", ["dos", "tres"]) for i in range(40)]
    assert one(spark, R.rotate_phrases(F.col("t"), phrases), t="uno 3 uno 3 a uno 3") == "tres dos a uno 3"
