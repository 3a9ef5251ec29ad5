"""Learned decision lists for text quality.

Sequential covering: from labelled statistics, rules that find low quality are grown one after the
other. A rule is a conjunction of thresholds on statistics; growing adds the threshold with the best
information gain until the rule covers no good document; pruning on held-out rows drops thresholds
from the end while precision doesn't fall; rows that a rule covers leave the training set. A rule
under the least precision ends the list. The list becomes one ordered conditional expression.

Statistics are DataFrame expressions; fitting takes at most ``MOST_LABELLED`` labelled rows, by the
order of the ids' hash, and runs in plain Python on the driver. Scoring is a map: nothing is shuffled.

Null texts have no words; documents under the base limits are rejected whatever the list says. With
no labels, or labels of one kind, the list is empty and every other document is kept. Repeated rows
each get their own verdict.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import SPACES, WORD, packed, text_of

#: Labelled rows that fitting takes.
MOST_LABELLED = 4_000
SYMBOLS = "#*$%&|<>"
STATISTICS = ("symbol_share", "repeat_share", "dup_line_share", "upper_share", "mean_word", "digit_share", "mark_share", "lone_share")


def with_counts(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """The counted columns, after the columns ``keep``.

    Words, windows and lines are columns of their own because several expressions read each.
    """
    text = F.col("_text")
    rows = docs.select(*keep, text_of(text_col).alias("_text"))
    rows = rows.withColumns(
        {
            "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
            "_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    n = F.size("_words")

    def third(k: int) -> Column:
        return F.slice("_words", k, F.greatest(n - 2, F.lit(0)))

    windows = F.transform(
        F.arrays_zip(third(1).alias("a"), third(2).alias("b"), third(3).alias("c")),
        lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.alias("i")),
    )
    rows = rows.withColumn("_windows", F.sort_array(windows))
    m = F.greatest(F.size("_windows") - 1, F.lit(0))
    twice = F.filter(
        F.zip_with(
            F.slice("_windows", 1, m),
            F.slice("_windows", 2, m),
            lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], x["i"] + 1, x["i"] + 2, y["i"], y["i"] + 1, y["i"] + 2)),
        ),
        lambda x: x.isNotNull(),
    )
    size = F.length(text)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (size - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct(F.flatten(twice))).cast("long").alias("n_repeat_words"),
        (size - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        (size - F.length(F.translate(text, "0123456789", ""))).cast("long").alias("n_digits"),
        (size - F.length(F.translate(text, "!?", ""))).cast("long").alias("n_marks"),
        F.size(F.filter("_words", lambda w: F.length(w) == 1)).cast("long").alias("n_lone"),
    )
    # inline: filters on the counts stay above, else they are rewritten into the lambdas word by word
    return rows.select(*keep, F.inline(F.array(counts)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Shares that the rules' thresholds are on, over the columns of with_counts."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / chars,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper_share": F.col("n_upper") / chars,
        "mean_word": F.col("word_chars") / words,
        "digit_share": F.col("n_digits") / chars,
        "mark_share": F.col("n_marks") / words,
        "lone_share": F.col("n_lone") / words,
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.statistic] > self.threshold) == self.above

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _cuts(bad: list[float], good: list[float], most: int = 64) -> list[float]:
    """Midpoints where the label changes between neighbouring values, at most so many, evenly over the ranks.

    No other threshold has a better gain.
    """
    kinds: dict[float, set[int]] = {}
    for y, values in enumerate((bad, good)):
        for v in values:
            kinds.setdefault(v, set()).add(y)
    line = sorted(kinds)
    middles = [(a + b) / 2 for a, b in zip(line, line[1:]) if kinds[a] != kinds[b] or len(kinds[a]) > 1]
    step = max(1, math.ceil(len(middles) / most))
    return middles[(step - 1) // 2 :: step]


def _grow(bad: list[dict], good: list[dict], statistics_: tuple[str, ...]) -> Rule:
    rule: Rule = ()
    while good and bad and len(rule) < 4:
        before = math.log2(len(bad) / (len(bad) + len(good)))
        best, gained = None, 1e-9
        for s in statistics_:
            low, high = sorted(r[s] for r in bad), sorted(r[s] for r in good)
            for cut in _cuts(low, high):
                p, n = len(low) - bisect_right(low, cut), len(high) - bisect_right(high, cut)
                for above, p, n in ((True, p, n), (False, len(low) - p, len(high) - n)):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - before)
                        if gain > gained:
                            best, gained = Condition(s, above, cut), gain
        if best is None:
            break
        rule += (best,)
        bad, good = [r for r in bad if best.holds(r)], [r for r in good if best.holds(r)]
    return rule


def _worth(rule: Rule, bad: list[dict], good: list[dict]) -> float:
    p, n = sum(covers(rule, r) for r in bad), sum(covers(rule, r) for r in good)
    return (p - n) / max(1, p + n)


def _prune(rule: Rule, bad: list[dict], good: list[dict]) -> Rule:
    best = rule
    for size in range(len(rule) - 1, 0, -1):
        if _worth(rule[:size], bad, good) >= _worth(best, bad, good):
            best = rule[:size]
    return best


def learn(rows: list[tuple[dict, int]], statistics_: tuple[str, ...] = STATISTICS, *, precision: float = 0.95, support: int = 5, most_rules: int = 12) -> list[Rule]:
    """Ordered rules that find rows with label 0 among (statistics, label) rows."""
    bad, good = [r for r, y in rows if y == 0], [r for r, y in rows if y == 1]
    rules: list[Rule] = []
    while len(bad) >= support and good and len(rules) < most_rules:
        grow, held = ([x for i, x in enumerate(bad) if i % 3], [x for i, x in enumerate(good) if i % 3]), (bad[::3], good[::3])
        rule = _grow(*grow, statistics_)
        if not rule:
            break
        rule = _prune(rule, *held)
        p, n = sum(covers(rule, r) for r in bad), sum(covers(rule, r) for r in good)
        if p < support or p < precision * (p + n):
            break
        rules.append(rule)
        bad, good = [r for r in bad if not covers(rule, r)], [r for r in good if not covers(rule, r)]
    return rules


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> list[Rule]:
    """The decision list learned from the labelled documents that the base limits don't reject.

    ``most`` bounds the labels that are joined to texts and the rows that reach the driver: the first
    labels of documents in ``docs`` by the order of the ids' hash, and as many rows of statistics
    where ids repeat; equal rows are one.
    """
    there = docs.select(F.col(id_col).alias("_there")).distinct()
    chosen = (
        labels.where(F.col(label_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .join(there, F.col("_id") == F.col("_there"), "left_semi")
        .orderBy(F.xxhash64("_id"), "_id", "_y")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_labelled")).where("_labelled is not null")
    some = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))  # at most ``most`` rows of two numbers
    counted = with_counts(some, "_labelled", "_id", "_y").where(~base_failed())
    shares = counted.select("_id", "_y", *(c.alias(s) for s, c in statistics().items())).distinct()
    rows = shares.orderBy("_id", "_y", *STATISTICS).limit(most).collect()
    return learn([({s: r[s] for s in STATISTICS}, r["_y"]) for r in rows])


def verdict(rules: list[Rule]) -> Column:
    """One conditional expression: the first rule that holds rejects, else the document is kept."""
    found, out = statistics(), None
    for rule in rules:
        holds = F.lit(True)
        for c in rule:
            holds = holds & (found[c.statistic] > c.threshold if c.above else found[c.statistic] <= c.threshold)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the counts, base_failed and kept for every row."""
    return with_counts(docs, text_col, id_col).select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule], *, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with the columns of ``docs``."""
    counted = with_counts(packed(docs, _judged=F.col(text_col)), "_judged", "row")
    return counted.where(~base_failed() & verdict(rules)).select("row.*")
