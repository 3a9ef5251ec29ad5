"""Decontamination, revisits, the pipeline and the registered queries."""

import os

import pytest
from pyspark.sql import functions as F

from folioforge.llm import decontaminate, simhash, warc
from folioforge.llm.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")

ITEM = "A train leaves Paris at 60 km per hour and meets Anna after 3 hours, then Anna walks 60 meters; how far is it from Paris"


def test_templates():
    tokens, values = decontaminate.Templates().tokens("We met Anna at 60 km. She paid $5.")
    assert tokens == ["we", "met", "<NAME>", "at", "<NUM>", "<UNIT>", "she", "paid", "<NUM>"]
    assert values[2] == "anna" and values[4] == "60"


def test_slots_must_be_consistent():
    assert decontaminate.consistent([("<NUM>", "60", "80"), ("<NUM>", "3", "4"), ("<NUM>", "60", "80")])
    assert not decontaminate.consistent([("<NUM>", "60", "80"), ("<NUM>", "60", "70")])
    assert not decontaminate.consistent([("<NUM>", "60", "80"), ("<NUM>", "3", "80")])


def cases(prose):
    filler = prose(60, 1)
    changed = ITEM.replace("60", "75").replace("Paris", "Lyon").replace("Anna", "Maria")
    broken = ITEM.replace("60 km", "75 km")
    return {
        1: (f"{filler} so: {ITEM} {filler}", [1]),
        2: (f"{filler} so: {changed.lower().replace('lyon', 'Lyon').replace('maria', 'Maria')} {filler}", [1]),
        3: (f"{filler} so: {broken} {filler}", []),
        4: (filler, []),
        5: (None, []),
        6: ("", []),
        7: (" ".join(ITEM.split()[:8]) + " " + filler, []),
        8: (f"{filler}\n{ITEM.upper()}\n{filler}", []),
        9: ("A B C D E F G H I J " * 50, []),
        10: (f"{filler} {' '.join(prose(60, 77).split()[20:38])} {filler}", [5]),
    }


@pytest.mark.parametrize("most", [None, 0])
def test_contamination(documents, prose, spark, monkeypatch, most):
    if most is not None:
        monkeypatch.setattr(decontaminate, "MOST_CHARACTERS", most)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "12 12 12"), (4, ""), (5, prose(60, 77))], "item_id long, text string")
    want = cases(prose)
    docs = documents([(i, t) for i, (t, _) in want.items()] + [(1, want[1][0])])
    got = {r.doc_id: (r["items"], r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {i: (found, bool(found)) for i, (_, found) in want.items()}
    kept = decontaminate.clean(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, (_, found) in want.items() if not found] and kept.columns == docs.columns
    assert decontaminate.contamination(docs.limit(0), items).collect() == []
    assert {r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {False}


RECORDS = "record_id long, url string, at long, revisit boolean, headers map<string,string>, digest string"


def plain_resolution(rows, canonical):
    out = {}
    for i, url, at, revisit, headers, _ in rows:
        if not revisit:
            continue
        best = max(((a, j) for j, u, a, r, _, _ in rows if not r and canonical[u] and canonical[u] == canonical[url] and at is not None and a is not None and a < at), default=None)
        out[i, at] = best[1] if best else None
    return out


def test_revisits(spark):
    import random

    rng = random.Random(1)
    urls = ["http://WWW.A.com:80/x/?utm_source=q#f", "https://a.com/x", "http://b.org/?id=1&ref=z", "nothing", None]
    rows = []
    for i in range(300):
        revisit = rng.random() < 0.5
        tag = rng.choice(["e1", "e2"])
        rows.append((i, rng.choice(urls), rng.choice([None, *range(40)]), revisit, rng.choice([{"etag": ("W/" if revisit else "") + tag, "date": str(i), "content-length": "0"}, {}, None]), None))
    df = spark.createDataFrame(rows, RECORDS)
    canonical = {u: c for u, c in df.select("url", warc.canonical_url(F.col("url"))).distinct().collect()}
    assert canonical[urls[0]] == canonical[urls[1]] == "a.com/x" and canonical[urls[2]] == "b.org?id=1" and canonical["nothing"] is None
    want = plain_resolution(rows, canonical)
    by_id = {r[0]: r for r in rows}
    for buckets in (1, 7, 100):
        got = warc.resolve_revisits(df, buckets=buckets).collect()
        assert len(got) == sum(r[3] for r in rows)
        assert {(r.record_id, r.at): r.response_id for r in got} == want
    for r in got:
        if r.response_id is None:
            assert r.verdict == "unresolved" and r.headers is None
            continue
        a, b = (by_id[r.record_id][4] or {}).get("etag"), (by_id[r.response_id][4] or {}).get("etag")
        assert r.verdict == ("unverified" if not a or not b else "resolved" if a.removeprefix("W/") == b else "changed")
        if r.verdict == "resolved":
            assert r.headers["content-length"] == "0" and r.headers["date"] == str(r.record_id) and r.headers["etag"] == a
    assert warc.resolve_revisits(df.limit(0)).collect() == []
    twice = warc.resolve_revisits(df.union(df)).collect()
    assert len(twice) == 2 * len(got)


def plain_similar(texts, k=5):
    sets = {i: {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if (w := t.lower().split()) else set() for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and (texts[a] == texts[b] or (sets[a] & sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_similar_groups_against_brute_force(documents, prose):
    import random

    rng = random.Random(7)
    texts = {i: prose(250, i) for i in range(30)}
    for i in range(60):
        words = texts[i % 15].split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        texts[100 + i] = " ".join(words)
    got = {r.doc_id: r.group for r in simhash.similar_groups(documents(list(texts.items()))).collect()}
    want = plain_similar(texts)
    assert all(want[i] == want[got[i]] for i in texts)
    linked = [i for i in texts if want[i] != i]
    assert sum(got[i] == want[i] for i in linked) >= 0.95 * len(linked)


@needs_data
def test_pipeline_keeps_clean_documents(spark, documents, prose, tmp_path):
    import corpus_pipeline

    clean = [(i, prose(150, i), f"s{i % 3}") for i in range(40)]
    item = prose(30, 900)
    rows = clean + [
        (100, clean[0][1], "s0"), (101, clean[1][1] + " more", "s1"), (102, " ".join(f"{w}%%%" for w in prose(90, 5).split()), "s1"),
        (103, prose(80, 6) + " " + item + " " + prose(40, 7), "s2"), (104, prose(80, 8) + " password=hunter2hunter2 " + prose(40, 9), "s2"), (105, None, None), (106, "", "s0"),
    ]
    bad = [(1000 + i, " ".join(f"{w}$$$" for w in prose(90, 50 + i).split()), "s0") for i in range(20)]
    folder = str(tmp_path / "in")
    documents(rows + bad).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(1000 + i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        sizes[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if k == 3:
            texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    good = {i for i, _, _ in clean}
    assert sizes["quality rules"] == good | {100, 101, 103, 104}
    assert sizes["simhash near-dedup"] == good | {103, 104}
    assert sizes["benchmark decontamination"] == good | {104} == sizes["secret scans"]
    assert "hunter2" not in texts[104][0] and texts[104][1] == len(texts[104][0]) and texts[3][0] == clean[3][1]
    assert sizes["mixing to target weights"] <= sizes["secret scans"]


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered(spark, name):
    df = QUERIES[name](spark, DATA)
    table = "pages" if name.startswith(("op4", "op7")) else "documents"
    rows = spark.read.parquet(f"{DATA}/{table}.parquet").count()
    if name.startswith("op11"):
        assert df.select("doc_id").distinct().count() == rows
    elif not name.startswith("op13"):
        assert df.count() == rows
    if name in ORACLE_SQL:
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "embeddings"):
            con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
        found = con.execute(ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_clashing_column_names(documents, prose, spark):
    """Helper columns of the operators may be there already."""
    from folioforge.llm import mixing, pii, quality_rules, secrets, suffix_dedup, token_counts, url_filter

    docs = documents([(i, prose(60, i)) for i in range(5)])
    for c in ("size", "text_", "blob", "spans", "n", "id", "ver", "doc", "_id", "_text", "_words", "fp", "group", "node", "kept", "_row", "_first", "_blob", "_found", "taken", "target"):
        docs = docs.withColumn(c, F.lit(1))
    page = spark.createDataFrame([(i, f"http://h{i}.com/a", "x", 1, 1, 1, 1, 1) for i in range(5)], "page_id long, url string, html string, host int, path int, rule int, canonical int, at int")
    assert warc.resolve_revisits(warc.records_of_pages(page)).count() == 5
    assert url_filter.filter_urls(page, url_filter.fit(url_filter.labelled_urls(spark))).count() == 5
    items = documents([(1, "x y z")]).select(F.col("doc_id").alias("item_id"), "text").withColumn("items", F.lit(1)).withColumn("i", F.lit(1)).withColumn("place", F.lit(1))
    for out in (
        mixing.mix(docs), secrets.secret_spans(docs), pii.find_personal_data(docs), simhash.near_duplicates(docs), token_counts.token_counts(docs), suffix_dedup.dedup_substrings(docs),
        decontaminate.contamination(docs.withColumn("items", F.lit(1)).withColumn("i", F.lit(1)), items), quality_rules.judge(docs, []), quality_rules.keep_good(docs, []), simhash.keep_one(docs), secrets.redact(docs),
        decontaminate.clean(docs, documents([(1, "x")]).select(F.col("doc_id").alias("item_id"), "text")),
    ):
        assert out.count() == 5


def test_nulls_in_any_column(spark, documents, prose):
    """Null ids, texts, languages, sources; ids beyond the doubles' whole numbers beside a null id."""
    from folioforge.llm import mixing, pii, quality_rules, secrets, suffix_dedup, token_counts

    big = 2**60 + 1
    text = prose(80, 1)
    docs = documents([(None, text, None), (None, None, None), (big, text), (big + 1, prose(90, 2)), (3, None)]).coalesce(1)
    items = spark.createDataFrame([(None, text), (7, None), (None, None)], "item_id long, text string")
    for out in (
        mixing.mix(docs), secrets.secret_spans(docs), pii.find_personal_data(docs), simhash.near_duplicates(docs), token_counts.token_counts(docs),
        suffix_dedup.dedup_substrings(docs), quality_rules.judge(docs, []), decontaminate.contamination(docs, items),
    ):
        assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([None, None, big, big + 1, 3], key=str)
    assert quality_rules.keep_good(docs, []).count() == 3 and secrets.redact(docs).count() == 5
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} >= {None, big, big + 1, 3}
    # what holds an item goes, also without an id of its own or of the item's
    assert sorted((r.doc_id for r in decontaminate.clean(docs, items).collect()), key=str) == sorted([None, big + 1, 3], key=str)
    pages = spark.createDataFrame([(None, None, None), (1, None, "x"), (None, "http://a.com/", None)], "page_id long, url string, html string")
    assert warc.resolve_revisits(warc.records_of_pages(pages)).count() == 3
    labels = spark.createDataFrame([(None, None, None), (big, None, 1), (None, 1, None)], "doc_id long, quality int, toxic int")
    assert quality_rules.fit(docs, labels) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "labels": "doc_id long, quality int, toxic int",
        "benchmark": "item_id long, text string",
        "pages": "page_id long, url string, html string",
        "embeddings": "vec_id long, embedding array<float>, label int",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
