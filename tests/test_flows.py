"""Flows and commands from files to results."""

import json

from pyspark.sql import functions as F

from folioforge.__main__ import main
from folioforge.operators import external as X
from folioforge.plans import flows
from folioforge.sources import http, pdf


def test_translate(spark, tmp_path):
    def upper(system, text):
        return text.upper().replace("<PROTECT_OLD_TOWN_1>", "< protect : Old Town >")

    (tmp_path / "g.json").write_text(json.dumps({"glossary": {"never_translate": ["Old Town"], "translations": {"king": "rey"}, "postprocess_rules": {"replace": {"(B)C": r"\1-c"}}}}))
    (tmp_path / "i.json").write_text(json.dumps({"replace": {"teh": "the"}}))
    g = flows.Glossary.read(spark, str(tmp_path / "g.json"), str(tmp_path / "i.json"))
    assert g.protect == [("Old Town", "<PROTECT_OLD_TOWN_1>")] and g.translations == [("king", "rey")]
    chapters = spark.createDataFrame([(1, "One", ["teh Old Town abc", "x"]), (2, "Two", []), (3, "Three", ["done"])], "number int, title string, paragraphs array<string>")
    done = chapters.where("number = 3")
    got = {r.number: (r.title, r.paragraphs) for r in flows.translate(chapters, g, upper, done=done, most=10).collect()}
    assert got == {1: ("ONE", ["THE Old Town AB-c", "X"]), 2: ("TWO", [])}


def test_polish_keeps_what_fails(spark):
    def half(system, text):
        if "bad" in text:
            raise RuntimeError
        return text.upper()

    chapters = spark.createDataFrame([(1, "t", ["good one", "bad one"])], "number int, title string, paragraphs array<string>")
    assert flows.polish(chapters, half, most=8).first().paragraphs == ["GOOD ONE", "bad one"]


def test_glossary_and_checks(spark):
    caches = spark.createDataFrame([(1, 0, "王", "Stone King"), (2, 0, "王", "Stone King"), (2, 1, "王", "King"), (1, 1, "树", "Oak"), (1, 2, "坏", "坏")], "chapter int, pos int, cn string, en string")
    patch = spark.createDataFrame([("oak", "Roble")], "en string, es string")
    master = flows.build_glossary(caches, rules=[(r"^(\w+) King$", "Rey $1")], patch=patch)
    assert {tuple(r) for r in master.collect()} == {("王", "Stone King", "Rey Stone"), ("树", "Oak", "Roble")}
    texts = lambda *rows: spark.createDataFrame(list(rows), "number int, text string")
    edges = spark.createDataFrame([(5, 1)], "en int, cn int")
    got = flows.check_translations(texts((1, "王 树"), (2, "王")), texts((5, "the Stone King")), texts((1, "el Oak y Rey Stone")), edges, master)
    assert got["issues"].count() == 0
    assert {(r.cn, r.status, r.leaked) for r in got["names"].collect()} == {("王", "ok", False), ("树", "missing", True)}
    assert tuple(got["totals"].first()) == (1, 1, 1)
    assert {(r.number, r.status) for r in got["references"].collect()} == {(1, "both"), (2, "missing es")}


def test_commands(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in (1, 2, 5):
        (folder / f"{n:04d}.txt").write_text(f"Capítulo {n}: T{n}\n\nbody {n} <protect old_town>\n")
    (tmp_path / "g.json").write_text(json.dumps({"never_translate": ["Old Town"]}))
    assert main(["export", "epub", "--input", str(folder), "--output", str(tmp_path / "e"), "--block-size", "2"], spark) == 0
    assert sorted(p.name for p in (tmp_path / "e").iterdir()) == ["book_000.epub", "book_001.epub"]
    assert main(["export", "pdf", "--input", str(folder), "--output", str(tmp_path / "p"), "--range", "2-1"], spark) == 0
    assert (tmp_path / "p" / "book_000.pdf").read_bytes().startswith(b"%PDF-1.4")
    assert main(["index", "--input", str(folder), "--output", str(tmp_path / "i")], spark) == 0
    assert [(r.number, r.title) for r in spark.read.json(str(tmp_path / "i")).orderBy("number").collect()] == [(1, "T1"), (2, "T2"), (5, "T5")]
    assert main(["repair", "--input", str(folder), "--output", str(tmp_path / "r"), "--glossary", str(tmp_path / "g.json")], spark) == 0
    assert spark.read.text(str(tmp_path / "r")).where(F.contains("value", F.lit("Old Town"))).count() == 3
    assert main(["combine", "--input", str(folder), "--output", str(tmp_path / "c"), "--count", "4"], spark) == 0
    assert spark.read.text(str(tmp_path / "c")).where("value = repeat('=', 40)").count() == 3


def test_http(spark):
    tries, slept = [], []

    def flaky(url):
        tries.append(url)
        if len(tries) < 3:
            raise OSError("down")
        return 200, "<a href='x'>ok</a>" + "y" * 5000

    assert http.get("u", flaky, sleep=slept.append).startswith("<a") and slept == [1.0, 1.5]

    def site(url):
        return (403, "no") if "no" in url else (200, '<a href="/c/1">1</a><a href="/c/1">1</a><a href="c2">2</a>')

    urls = spark.createDataFrame([("https://h.com/a/b",), ("https://h.com/no",)], "url string")
    pages = http.fetch_pages(urls, site, delay=0)
    assert {(r.url, r.error) for r in pages.collect()} == {("https://h.com/a/b", None), ("https://h.com/no", "403 from https://h.com/no")}
    assert {r.link for r in http.catalogue_links(pages).collect()} == {"https://h.com/c/1", "https://h.com/a/c2"}


def test_pdf_escapes_and_pages():
    data = pdf.pdf_bytes("T (x)", "A", [("One", ["word " * 2000]), ("苏", [])])
    assert rb"T \(x\)" in data and data.count(b"/Type /Page ") == 5
    assert b"(?)" in data and data.rstrip().endswith(b"%%EOF")


def test_stub_is_deterministic():
    assert X.echo("ab", "c") == "[2] c"
