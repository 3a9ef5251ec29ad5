"""Votes as chapters arrive against the batch vote; progress; pages that resume."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import glossary as G
from folioforge.progress import Report, progress
from folioforge.streaming import votes as V


def batch_vote(spark, extractions):
    latest = {}
    for chapter, version, pairs in extractions:
        if chapter not in latest or version > latest[chapter][0]:
            latest[chapter] = (version, pairs)
    rows = [(c, p, cn, en) for c, (_, pairs) in latest.items() for p, cn, en in pairs]
    caches = spark.createDataFrame(rows, "chapter long, pos long, cn string, en string").distinct()
    return sorted(tuple(r) for r in G.majority_vote(G.pair_counts(caches)).collect())


def test_votes_equal_the_batch_after_any_order(spark, tmp_path):
    rng = random.Random(1)
    made = [(c, v, [(p, rng.choice("甲乙丙丁"), rng.choice(["Ann", "Bob", "Cid"])) for p in range(rng.randint(0, 5))]) for c in range(12) for v in range(1, rng.randint(2, 4))]
    rng.shuffle(made)
    folder, log, mark = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "mark")
    folder.mkdir()
    shown = []
    for run in range(3):  # each run is a restart from the checkpoint
        for k, (c, v, pairs) in enumerate(made[run * len(made) // 3 : (run + 1) * len(made) // 3]):
            row = {"chapter": c, "version": v, "pairs": [{"pos": p, "cn": cn, "en": en} for p, cn, en in pairs]}
            (folder / f"{run}-{k}.json").write_text(json.dumps(row) + "\n")
            shown.append((c, v, pairs))
        V.follow(spark, str(folder), log, mark)
        assert sorted(tuple(r) for r in V.votes(spark.read.schema(V.CHANGE).parquet(log)).collect()) == batch_vote(spark, shown)
    before = spark.read.parquet(log).count()
    V.follow(spark, str(folder), log, mark)
    assert spark.read.parquet(log).count() == before and spark.read.parquet(log).where("sign < 0").count() > 0


def test_odd_extractions(spark, tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    folder.mkdir()
    rows = [{"chapter": 1, "version": 1, "pairs": [{"pos": 0, "cn": "甲", "en": None}, {"pos": None, "cn": "乙", "en": "Bob"}, {"pos": 1, "cn": "乙", "en": "Bob"}, {"pos": 1, "cn": "乙", "en": "Bob"}]}]
    rows += [{"chapter": None, "version": 1, "pairs": []}, {"chapter": 2, "version": None, "pairs": [{"pos": 0, "cn": "x", "en": "y"}]}, {"chapter": 3, "version": 1, "pairs": None}]
    (folder / "a.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    V.follow(spark, str(folder), log, str(tmp_path / "mark"))
    found = spark.read.schema(V.CHANGE).parquet(log)
    assert found.count() == 3 and [tuple(r) for r in V.votes(found).collect()] == [("乙", "Bob")]


def test_progress_counts_what_is_written(spark, tmp_path):
    said = []
    with progress(spark, said.append, every=0.05) as p:
        rows = p.watch(spark.range(0, 1000, 1, 7).withColumn("bad", F.col("id") % 10 == 0), failed=F.count_if("bad"))
        rows.repartition(3).write.parquet(str(tmp_path / "out"))
    assert p.counts() == {"rows": 1000, "failed": 100}
    assert said[-1].done == said[-1].known >= 10 and said[-1].rest == 0
    assert str(Report(0, 5, 2.0)) == "0/5 tasks, 0.0 a minute" and str(Report(2, 6, 60.0)) == "2/6 tasks, 2.0 a minute, 120 s to go"


def asked(note):
    return sorted(open(note).read().split()) if note.exists() else []


def test_pages_land_once(spark, tmp_path):
    import os

    from folioforge.sources import pages as P

    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "page_site.py"))
    note, catalogue = tmp_path / "asked", tmp_path / "urls.txt"
    url = lambda k: f"http://s/{k}{'down' if k == 3 else ''}#note={note}"
    catalogue.write_text("".join(url(k) + "\n" for k in range(9)) + "\nhttp://s/half")
    options = {"catalogue": str(catalogue), "landing": str(tmp_path / "landed"), "fetcher": "page_site:site", "chunk": "4", "delay": "0"}
    source = spark.read.format(P.register(spark)).options(**options)
    assert {r.position: r.error is None for r in source.options(first="2", last="5").load().collect()} == {2: True, 3: False, 4: True}
    assert asked(note) == ["http://s/2", "http://s/3down", "http://s/4"]
    read = spark.read.format(P.Pages.name()).options(**options).load()
    assert read.count() == 9
    # what has landed isn't asked for again, what failed is
    assert asked(note) == sorted([f"http://s/{k}" for k in range(9) if k != 3] + ["http://s/3down"] * 2)

    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run(broken=False):
        rows = spark.readStream.format(P.Pages.name()).options(**options).load()
        if broken:
            rows = rows.withColumn("html", F.when(F.col("position") == 11, F.raise_error(F.lit("killed"))).otherwise(F.col("html")))
        q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception:
            assert broken

    run()
    assert spark.read.parquet(out).count() == 9
    catalogue.write_text("".join(url(k) + "\n" for k in range(9)) + "\n" + "".join(url(k) + "\n" for k in range(10, 14)))
    before = asked(note)
    run(broken=True)
    run()
    got = [r.position for r in spark.read.parquet(out).select("position").collect()]
    assert sorted(got) == [k for k in range(14) if k != 9]
    later = asked(note)
    assert sorted(set(later) - set(before)) == [f"http://s/{k}" for k in range(10, 14)] and all(later.count(f"http://s/{k}") == 1 for k in range(10, 14))
