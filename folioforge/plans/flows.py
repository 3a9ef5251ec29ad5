"""End-to-end flows: translate, build and patch a glossary, check translations, package.

Each is one DataFrame plan; nothing runs until its result is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import replace as R
from folioforge.functions import sequence as Q
from folioforge.functions import text as T
from folioforge.operators import external as X
from folioforge.operators import glossary as G
from folioforge.operators import quality as C
from folioforge.sources import files as S
from folioforge.sources import pdf as P
from folioforge.sources import sinks as K


@dataclass(frozen=True)
class Glossary:
    """Rule lists in their order: (term, replacement), (term, token), (token, term), (pattern, template)."""

    never_translate: list[str] = field(default_factory=list)
    translations: list[tuple[str, str]] = field(default_factory=list)
    ingest: list[tuple[str, str]] = field(default_factory=list)
    protect: list[tuple[str, str]] = field(default_factory=list)
    restore: list[tuple[str, str]] = field(default_factory=list)
    post: list[tuple[str, str]] = field(default_factory=list)

    @classmethod
    def read(cls, spark: SparkSession, path: str, ingest_path: str | None = None) -> Glossary:
        """From JSON files, with or without the outer "glossary"; placeholders are made for terms without."""
        files = S.text_files(spark, path)

        def pairs(field_: str, source: DataFrame = files, wrapper: str | None = "glossary") -> list[tuple[str, str]]:
            return [(r.key, r.value) for r in S.json_map(source, wrapper, field_).orderBy("path", "ord").collect()]

        body = F.coalesce(F.get_json_object("value", "$.glossary"), F.col("value"))
        names = files.select(F.posexplode(F.from_json(F.get_json_object(body, "$.never_translate"), "array<string>")).alias("ord", "term"))
        protect, restore = pairs("preprocess_rules.protect_tokens"), pairs("preprocess_rules.restore_tokens")
        held = [(t, w) for w, t in protect] + restore
        known = spark.createDataFrame([(k, t, w) for k, (t, w) in enumerate(held)], "ord int, token string, term string") if held else None
        made = R.placeholders(names, known)
        aliases = R.known_aliases(known, made).orderBy("token").collect() if held else []
        for r in made.orderBy("ord").collect():
            protect.append((r.term, r.token))
            restore.append((r.token, r.term))
            if r.alias:
                restore.append((r.alias, r.term))
        restore += [(r.token, r.term) for r in aliases]
        return cls(
            [r.term for r in names.orderBy("ord").collect()],
            pairs("translations"),
            pairs("replace", S.text_files(spark, ingest_path), None) if ingest_path else [],
            protect,
            restore,
            pairs("postprocess_rules.replace"),
        )


def translate(chapters: DataFrame, glossary: Glossary, model: X.Model, *, done: DataFrame | None = None, most: int = 7000, preamble: str = "Translate.", rules: list[str] = ()) -> DataFrame:
    """(number, title, paragraphs) translated: what is done is left out before the model, texts are prepared, cut into
    chunks, answered in parallel, put in order, restored, and split into paragraphs again. Titles go the same way."""
    left = chapters if done is None else C.not_done(chapters, done, "number")
    chunk = F.posexplode(F.transform(Q.chunks(F.col("paragraphs"), most), lambda c: F.array_join(c, "\n\n"))).alias("idx", "text")
    body = left.select("number", "title", chunk)
    heads = left.select("number", "title", F.lit(-1).alias("idx"), F.col("title").alias("text"))
    rows = heads.union(body).withColumn("key", F.concat_ws("/", "number", "idx"))
    rows = rows.withColumn("text", R.prepare(F.col("text"), glossary.ingest, glossary.protect))
    rows = rows.withColumn("prompt", X.prompt(preamble, list(rules), glossary.never_translate, glossary.translations, F.col("title")))
    answered = X.map_model(rows, model, text_col="text", prompt_col="prompt").select("number", "idx", "key", F.col("result").alias("text"))
    final = R.finalize(answered, "text", "key", glossary.restore, glossary.post)
    parts = F.sort_array(F.collect_list(F.struct("idx", "text")))
    whole = final.groupBy("number").agg(parts.alias("p"))
    texts = F.transform(F.filter("p", lambda x: x["idx"] >= 0), lambda x: x["text"])
    title = F.get(F.filter("p", lambda x: x["idx"] < 0), F.lit(0))["text"]
    return whole.select("number", T.strip(title).alias("title"), T.split_paragraphs(F.array_join(texts, "\n\n")).alias("paragraphs"))


def polish(chapters: DataFrame, model: X.Model, *, most: int = 6000) -> DataFrame:
    """Chapters through a model in chunks; where it fails the chunk stays."""
    chunk = F.posexplode(F.transform(Q.chunks(F.col("paragraphs"), most, 0), lambda c: F.array_join(c, "\n\n"))).alias("idx", "chunk")
    done = X.map_chunks(chapters.select("number", chunk), "number", X.keep_on_error(model))
    return chapters.select("number", "title").join(done, "number", "left").select("number", "title", T.split_paragraphs(F.array_join("results", "\n\n")).alias("paragraphs"))


def build_glossary(caches: DataFrame, *, verified: DataFrame | None = None, blocked: DataFrame | None = None, direct: dict[str, str] = {}, rules: list[tuple[str, str]] = (), extra: dict[str, str] = {}, passthrough: str | None = None, patch: DataFrame | None = None) -> DataFrame:
    """(cn, en, es) from per-chapter caches (chapter, pos, cn, en): votes, overrides, rule translation, patch."""
    clean = caches.where(~F.col("en").rlike(T.CJK))
    voted = G.majority_vote(G.pair_counts(clean, blocked=blocked), verified=verified)
    master = voted.withColumn("es", G.cascade(F.col("en"), dict(direct), list(rules), dict(extra), passthrough))
    return master if patch is None else G.override_patch(master, patch).select("cn", "en", "es")


def check_translations(cn: DataFrame, en: DataFrame, es: DataFrame, alignment: DataFrame, master: DataFrame) -> dict[str, DataFrame]:
    """Reports: names missing by chapter, names by status, totals, the most missed, and chapters without a reference.

    cn, en, es: (number, text). The consistency check goes through the alignment, the name report pairs
    numbers directly; both joins are kept apart.
    """
    aligned = alignment.join(en.select(F.col("number").alias("en"), F.col("text").alias("t")), "en").groupBy("cn").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("en", "t"))), lambda x: x["t"]), "\n").alias("en_text")
    )
    pairs = aligned.join(es.select(F.col("number").alias("cn"), F.col("text").alias("es_text")), "cn").withColumnRenamed("cn", "id")
    issues = C.top_by_length(C.missing_translations(pairs, C.translations_of(master)), "id", "en")
    direct = cn.select(F.col("number").alias("id"), F.col("text").alias("cn_text")).join(es.select(F.col("number").alias("id"), F.col("text").alias("es_text")), "id")
    report = C.name_report(direct, master)
    return {"issues": issues, "names": report, "totals": C.report_totals(report), "top": C.top_missing(report), "references": C.reference_status(cn, es, "number", ("cn", "es"))}


def package(chapters: DataFrame, size: int, title: str, author: str = "", *, low: int | None = None, high: int | None = None, kind: str = "epub") -> DataFrame:
    """(block, n_chapters, content): EPUB or PDF files of ``size`` chapters each, by position."""
    rows = chapters if low is None else chapters.where(C.in_range(F.col("number"), low, high))
    blocks = Q.fixed_blocks(rows, ["number"], size)
    return (K.epubs if kind == "epub" else P.pdfs)(blocks, "block", title, author)
