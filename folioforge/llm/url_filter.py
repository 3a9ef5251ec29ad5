"""URL filter: host and path rules, then a logistic regression on hashed character n-grams.

Fitting takes a small labelled table of URLs: its features are computed by the same DataFrame
expressions as the pages', at most ``MOST_LABELLED`` rows go to the driver, and full-batch gradient
descent runs there. Scoring is one expression over array literals: no join, no shuffle, no Python.

Null URLs and URLs without "://" have an empty host and path, fit no rule, and are judged by the
model's intercept and the n-grams of the empty parts. Repeated rows each get their own verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the labelled table that fitting takes, by the order of the URLs' hash.
MOST_LABELLED = 5_000
BUCKETS = 1_024
GRAMS = (3, 4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path start, verdict)
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)

_GOOD_HOSTS = (
    "www.city-library.example.org", "news.harbour.example.com", "docs.compiler.example.net", "blog.gardening.example.org",
    "museum.example.org", "www.physics-notes.example.com", "m.weather.example.net", "recipes.example.com",
    "history.example.net", "www.open-maps.example.org", "blog.river-walks.example.com", "school.example.net",
    "m.orchard.example.com", "theatre.example.org", "www.railway.example.net", "blog.another.example.com",
    "tension.example.org", "interest.example.net", "www.northern.example.com", "m.edition.example.org",
)
_BAD_HOSTS = (
    "spam-farm.example.org", "www.cheap-pills.example.com", "free-casino.example.net", "free-betting.example.org", "win-cash-now.example.com",
    "xxx-cams.example.net", "www.cheap-watches.example.org", "spam-links.example.com", "pills-online.example.net",
    "casino-bonus.example.org", "hot-singles.example.com", "www.free-cash.example.net", "replica-deals.example.org",
)
#: Paths that either kind of host may have, and paths of spam wherever they are.
_PLAIN_PATHS = ("/en/12", "/fr/120/", "/de/471.html", "/es/907", "/en/588/", "/wiki/Bridge", "/archive/2019/05", "")
_BAD_PATHS = ("/buy-now/pills", "/free-casino/bonus", "/win/free-cash", "/xxx/cams", "/cheap-pills/deal.html")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table (url, blocked): ordinary and spam hosts with plain and spam paths."""
    rows = [(f"https://{h}{p}", 0) for h in _GOOD_HOSTS for p in _PLAIN_PATHS]
    rows += [(f"http://{h}{p}", 1) for h in _BAD_HOSTS for p in _PLAIN_PATHS]
    rows += [(f"https://{h}{p}", 1) for h in _GOOD_HOSTS[::2] for p in _BAD_PATHS]
    return spark.createDataFrame(rows, "url string, blocked int")


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def framed(part: Column) -> Column:
    return F.concat(F.lit("^"), part, F.lit("$"))


def grams(text: Column, name: str) -> Column:
    """Bucket numbers of the character n-grams of a framed part.

    ``text`` is to be a column of its own, not an expression: every n-gram reads it.
    """

    def of(n: int) -> Column:
        salt = F.lit(f"{name}{n}")
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.transform(
            starts, lambda i: F.pmod(F.xxhash64(salt, F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int")
        )

    return F.concat(*(of(n) for n in GRAMS))


def with_parts(table: DataFrame, url: Column, *more: Column) -> DataFrame:
    """host, path and their framed forms, as columns that the projections above read many times."""
    parts = table.select(*more, host_of(url).alias("host"), path_of(url).alias("path"))
    return parts.withColumns({"_h": framed(F.col("host")), "_p": framed(F.col("path"))})


def fit(labelled: DataFrame, *, url_col: str = "url", label_col: str = "blocked", steps: int = 250, rate: float = 2.0, l2: float = 1e-4) -> dict:
    """Weights by part and the intercept. Features are the shares of a part's n-grams in each bucket.

    An empty table gives the model that allows everything.
    """
    url = F.col(url_col)
    rows = (
        labelled.where(url.isNotNull() & F.col(label_col).isNotNull())
        .select(url.alias("u"), F.col(label_col).cast("int").alias("y"))
        .orderBy(F.xxhash64("u"), "u", "y")
        .limit(MOST_LABELLED)
    )
    rows = (
        with_parts(rows, F.col("u"), F.col("u"), F.col("y"))
        .select(grams(F.col("_h"), "host").alias("h"), grams(F.col("_p"), "path").alias("p"), "y", "u")
        .collect()
    )
    rows.sort(key=lambda r: (r.u, r.y))
    weights = {"host": [0.0] * BUCKETS, "path": [0.0] * BUCKETS, "bias": 0.0 if rows else -1.0}
    examples = [(((("host", r.h), ("path", r.p))), r.y) for r in rows]
    for _ in range(steps if rows else 0):
        change = {"host": [0.0] * BUCKETS, "path": [0.0] * BUCKETS}
        bias = 0.0
        for parts, y in examples:
            miss = y - 1 / (1 + math.exp(-_logit(weights, parts)))
            bias += miss
            for name, found in parts:
                for g in found:
                    change[name][g] += miss / len(found)
        for name in change:
            own = weights[name]
            for g, d in enumerate(change[name]):
                own[g] += rate * (40 * d / len(examples) - l2 * own[g])
        weights["bias"] += rate * bias / len(examples)
    return {"host": weights["host"], "path": weights["path"], "bias": weights["bias"]}


def _logit(weights: dict, parts) -> float:
    return weights["bias"] + sum(sum(weights[n][g] for g in found) / max(1, len(found)) for n, found in parts)


def score(model: dict) -> Column:
    """Logit that a URL is to be blocked, over the columns of with_parts."""
    total = F.lit(model["bias"])
    for name, text in (("host", F.col("_h")), ("path", F.col("_p"))):
        held = F.array(*(F.lit(round(w, 6)) for w in model[name]))
        found = grams(text, name)
        summed = F.aggregate(F.transform(found, lambda g: F.element_at(held, g + 1)), F.lit(0.0), lambda s, w: s + w)
        total = total + summed / F.greatest(F.size(found), F.lit(1))
    return total


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def filter_urls(pages: DataFrame, model: dict, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, threshold: float = 0.65) -> DataFrame:
    """id, host, path, rule, verdict (allow or block), score for every row.

    Without a rule, a URL is blocked where the model's probability is above ``threshold``.
    """
    parts = with_parts(pages, F.col(url_col), F.col(id_col)).select(id_col, "host", "path", score(model).alias("score"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("score") > math.log(threshold / (1 - threshold)), "block").otherwise("allow")
    return parts.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score")
