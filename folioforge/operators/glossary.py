"""Glossaries as tables: frequencies, votes, inversion, priority merges, overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.sequence import numbered


#: Two to four capitalised ASCII words.
PHRASE = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}\b"


def document_frequency(texts: DataFrame, text_col: str, pattern: str = PHRASE) -> DataFrame:
    """(term, df): in how many rows a match of the pattern occurs. Rows count once, before the shuffle."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0))))
    return texts.select(found.alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def candidate_terms(frequencies: DataFrame, known: DataFrame | None = None, *, least: int = 3, common=(), first=(), last=(), indicators=()) -> DataFrame:
    """Terms that may be names: frequent, unknown, not shaped like a piece of a sentence. Sorted by df, then term.

    The word lists are the language's: words that begin sentences (``common``), that can't begin (``first``)
    or end (``last``) a name, or that stand in none (``indicators``).
    """
    words = F.split("term", r"\s+")
    head, tail = F.get(words, F.lit(0)), F.element_at(words, -1)
    out = frequencies.where(F.col("df") >= least)
    out = out.where(~head.isin(*common, *first) & ~head.rlike("(?:ing|ed)$") & ~tail.isin(*last))
    if indicators:
        out = out.where(~F.arrays_overlap(words, F.array(*(F.lit(w) for w in sorted(indicators)))))
    if known is not None:
        terms = known.select(F.col("term").alias("_known"))
        out = out.join(terms, F.col("term") == F.col("_known"), "left_anti")
        singular = F.when(tail.endswith("s"), F.expr("substring(term, 1, length(term) - 1)"))
        out = out.withColumn("_one", singular).join(terms, F.col("_one") == F.col("_known"), "left_anti").drop("_one")
    return out.orderBy(F.desc("df"), "term")


def pair_counts(caches: DataFrame, key: str = "cn", value: str = "en", order: list[str] = ("chapter", "pos"), blocked: DataFrame | None = None) -> DataFrame:
    """(key, value, n, first): votes for each pair and the first place it was seen at."""
    rows = caches.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    if blocked is not None:
        rows = rows.join(blocked.select(key), key, "left_anti")
    return rows.groupBy(key, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))


def majority_vote(counts: DataFrame, key: str = "cn", value: str = "en", verified: DataFrame | None = None) -> DataFrame:
    """(key, value): the value with most votes, of equals the one seen first; verified pairs override and add."""
    best = _first_of_most(counts, key, value)
    if verified is None:
        return best
    fixed = verified.select(key, F.col(value).alias("_fixed")).dropDuplicates([key])
    return best.join(fixed, key, "full_outer").select(key, F.coalesce("_fixed", value).alias(value))


def _first_of_most(counts: DataFrame, key: str, value: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("n"), "first")
    return counts.withColumn("_k", F.row_number().over(order)).where("_k = 1").select(key, value)


def vote_conflicts(counts: DataFrame, key: str = "cn", value: str = "en") -> DataFrame:
    """All options of keys with several values: (key, value, n, won)."""
    each = Window.partitionBy(key)
    order = each.orderBy(F.desc("n"), "first")
    marked = counts.withColumn("options", F.count("*").over(each)).withColumn("won", F.row_number().over(order) == 1)
    return marked.where("options > 1").select(key, value, "n", "won")


def invert_map(edges: DataFrame, key: str, value: str) -> DataFrame:
    """(value, keys): the sorted distinct keys of each value."""
    return edges.groupBy(value).agg(F.sort_array(F.collect_set(key)).alias("keys"))


def priority_merge(*maps: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """One value a key: the one from the last map that has it."""
    ranked = [m.select(key, F.col(value), F.lit(i).alias("_rank")) for i, m in enumerate(maps)]
    both = ranked[0]
    for more in ranked[1:]:
        both = both.unionByName(more)
    return both.groupBy(key).agg(F.max_by(value, "_rank").alias(value))


def insert_if_absent(first: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Rows of ``first`` and those of ``more`` with new keys."""
    return first.unionByName(more.join(first.select(key), key, "left_anti"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def translate_unknown(terms: DataFrame, known: DataFrame, translate, key: str = "term", value: str = "translation") -> DataFrame:
    """Known terms from the table; the distinct rest through ``translate`` (DataFrame of terms -> term, translation);
    what it leaves stays itself."""
    rest = terms.select(key).distinct().join(known.select(key), key, "left_anti")
    held = insert_if_absent(known.select(key, value), translate(rest).select(key, value), key)
    return terms.join(held, key, "left").withColumn(value, F.coalesce(value, key))


def override_patch(master: DataFrame, patch: DataFrame, *, keywords: list[str] = ()) -> DataFrame:
    """master (cn, en, es) with es from patch (en, es) where en agrees in either case.

    changed tells where es is new; suspicious, where es equals en in either case and holds a keyword.
    """
    fix = patch.select(F.lower("en").alias("_en"), F.col("es").alias("_es")).dropDuplicates(["_en"])
    out = master.join(fix, F.lower("en") == F.col("_en"), "left")
    same = F.lower(F.coalesce("_es", "es")) == F.lower("en")
    titled = F.lit(False)
    for k in keywords:
        titled = titled | F.contains(F.lower("en"), F.lit(k.lower()))
    return out.select("cn", "en", F.coalesce("_es", "es").alias("es"), (F.col("_es").isNotNull() & (F.col("_es") != F.col("es"))).alias("changed"), (same & titled).alias("suspicious"))


def cascade(term: Column, direct: dict[str, str], rules: list[tuple[str, str]], extra: dict[str, str], passthrough: str | None = None) -> Column:
    """A term by the direct table, else the first rule that matches, else the extra table, else itself.

    ``passthrough`` is a pattern of terms that stay as they are before the end is reached.
    """

    def held(table: dict[str, str]) -> Column:
        return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), term) if table else F.lit(None).cast("string")

    ruled = F.lit(None).cast("string")
    for pattern, text in reversed(rules):
        ruled = F.when(term.rlike(pattern), F.regexp_replace(term, pattern, text)).otherwise(ruled)
    kept = F.when(term.rlike(passthrough), term) if passthrough else F.lit(None).cast("string")
    return F.coalesce(held(direct), ruled, held(extra), kept, term)


def shadowed_rules(rules: list[tuple[str, str]], samples: list[str]) -> list[int]:
    """Rules that never come first on the samples they match."""
    import re

    first, matched = set(), set()
    for s in samples:
        hits = [i for i, (p, _) in enumerate(rules) if re.search(p, s)]
        matched.update(hits)
        first.update(hits[:1])
    return sorted(matched - first)


def merge_classified(never: DataFrame, translations: DataFrame, classified: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """classified (term, action protect/translate/ignore, translation) into both tables where new.

    Returns (never, translations, one row of counts).
    """
    protect = classified.where("action = 'protect'").select("term")
    translate = classified.where("action = 'translate' and translation is not null").select("term", "translation")
    new_never = protect.join(never.select("term"), "term", "left_anti").distinct()
    new_translations = translate.join(translations.select("term"), "term", "left_anti").dropDuplicates(["term"])
    counts = classified.agg(
        F.count_if(F.col("action") == "protect").alias("protect"),
        F.count_if(F.col("action") == "translate").alias("translate"),
        F.count_if(F.col("action") == "ignore").alias("ignore"),
    )
    return never.select("term").union(new_never), translations.select("term", "translation").union(new_translations), counts


def in_batches(df: DataFrame, order: str, size: int = 20) -> DataFrame:
    """``batch``: rows of the order in slices of ``size``; no task numbers all rows."""
    return numbered(df, [order]).withColumn("batch", F.expr(f"place div {size}").cast("int")).drop("place")
