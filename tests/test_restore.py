"""Indexed look-up of placeholder names against the ordered rules."""

import random
import time

from pyspark.sql import functions as F

from folioforge.functions import replace as R
from folioforge.functions.restore import Restorer, segments_of


def ordered_rules(names, bare, restore, threshold):
    raw, mapped, base = names
    tries = [f"<PROTECT_{raw}>"] + [f"<PROTECT_{mapped}>"] * (mapped != raw) + [f"<PROTECT_{base}>"] * (base not in ("", raw))
    for t in tries:
        for token, term in restore:
            if token == t:
                return term
    for token, term in restore:
        if any(token.startswith(t.rstrip(">")) for t in tries):
            return term
    for name, own in zip(names, bare, strict=True):
        words = set(own.split("_")) - {""}
        scored = [(len(words & segments_of(token)) / max(len(words), len(segments_of(token)), 1), -k) for k, (token, _) in enumerate(restore)]
        if name and scored and max(scored)[0] >= threshold:
            return restore[-max(scored)[1]][1]
    return None


def made(rng, n, pool):
    word = lambda: rng.choice(pool)
    return [(f"<PROTECT_{'_'.join(word() for _ in range(rng.randint(1, 5)))}{rng.choice(['', '_1', '_2', '_17'])}>", f"term {k}") for k in range(n)]


def test_index_equals_the_rules():
    rng = random.Random(1)
    for _ in range(40):
        pool = [rng.choice("ABCDE") * rng.randint(1, 3) for _ in range(rng.choice([3, 12]))]
        restore, threshold = made(rng, rng.choice([1, 2, 3, 40, 130]), pool), rng.choice([0.3, 0.5, 0.66, 1.0])
        index = Restorer(restore, threshold)
        for _ in range(60):
            raw = "_".join(rng.choice([*pool, "Q"]) for _ in range(rng.randint(0, 5))) + rng.choice(["", "_3"])
            mapped = raw.replace("AA", "B") if rng.random() < 0.5 else raw
            base = raw.removesuffix("_3")
            names, bare = [raw, mapped, base], [n.removesuffix("_3") for n in (raw, mapped, base)]
            assert index(names, bare) == ordered_rules(names, bare, restore, threshold), (names, restore, threshold)


def test_fifty_thousand_tokens():
    rng = random.Random(2)
    pool = ["".join(rng.choice("ABCDEFGHIJKL") for _ in range(4)) for _ in range(4000)]
    restore = made(rng, 50_000, pool)
    index = Restorer(restore, 0.66)
    names = ["_".join(rng.sample(sorted(segments_of(rng.choice(restore)[0])) + [rng.choice(pool)], 2)) for _ in range(8)] + [restore[77][0][9:-1], pool[5], f"{pool[7]}_{pool[8]}_{pool[9]}"]
    began = time.time()
    got = [index([n] * 3, [n] * 3) for n in names]
    assert time.time() - began < 1
    assert got == [ordered_rules([n] * 3, [n] * 3, restore, 0.66) for n in names] and sum(g is not None for g in got) > 1


def test_columns_agree(spark, monkeypatch):
    rng = random.Random(3)
    pool = ["OLD", "TOWN", "WALL", "KING", "RIVER"]
    restore = made(rng, 30, pool)
    said = lambda: " ".join(rng.choice(["old", "Town", "wall", "Kíng", "x", "river_2", "3"]) for _ in range(rng.randint(0, 4)))
    rows = [(k, None if k == 5 else said(), None if k == 7 else f"a < PROTECT : {said()}> b <PROTEGER_{said()} > PROTECT_OLD_TOWN_1 {said()}") for k in range(60)]
    df = spark.createDataFrame(rows, "id int, name string, t string")
    found = []
    for nested in (0, 1000):
        monkeypatch.setattr(R, "NESTED", nested)
        looked_up = df.select("id", R.lookup_placeholder(F.col("name"), restore, {"X": "OLD"}).alias("term"))
        found.append(({r.id: r.term for r in looked_up.collect()}, {r.id: r.t for r in R.restore_all(df, "t", "id", restore, {"X": "OLD"}).collect()}))
        assert R.restore_all(df, "t", "id", restore).columns == df.columns
    assert found[0] == found[1]


def test_table_equals_the_rules(spark):
    """Names and tokens as tables, in many small ranges: equal, beginning, shared segments, ties, nulls."""
    rng = random.Random(5)
    pool = ["OLD", "OLDER", "TOWN", "WALL", "KING", "RIVER", "W"]
    restore = made(rng, 120, pool)
    said = lambda: " ".join(rng.choice(["old", "Town", "wall", "Kíng", "x", "river_2", "3", "w"]) for _ in range(rng.randint(0, 4)))
    names = spark.createDataFrame([(k, None if k == 5 else said()) for k in range(300)], "id int, name string").repartition(3)
    table = spark.createDataFrame([(10 * k, token, term) for k, (token, term) in enumerate(restore)] + [(7, None, "none")], "ord long, token string, term string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for segments in (None, {"X": "OLD"}):
            want = {r.id: r.term for r in names.select("id", R.lookup_placeholder(F.col("name"), restore, segments).alias("term")).collect()}
            got = R.lookup_placeholders(names, "name", table, segments).select("id", "term").collect()
            assert len(got) == 300 and {r.id: r.term for r in got} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
