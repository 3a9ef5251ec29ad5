"""Secret scans over an incremental blob ledger.

Every version of a text is a blob, addressed by the SHA-256 of its UTF-8 bytes. The ledger holds one
row for each (blob, rule version) ever scanned, clean blobs included. A run

1. addresses all rows in one pass over the texts; the same pass keeps the text only of rows that
   pass the rules' screens, conditions that every match fulfils, so clean texts are never moved;
2. takes the blobs that the ledger lacks under this rule version, each once however many paths hold it;
3. matches the rules over those, and appends findings and clean blobs to the ledger;
4. joins findings back to all paths by blob.

Counting paths per blob combines before the shuffle and picks one path for the text, so a blob with a
third of all rows costs one row per task; the join back is an equi-join that adaptive execution splits.

Positions count code points, ends exclusive. Match positions come from the lengths of the pieces
between matches and of the matches, summed in order. Null texts count as empty; the empty blob is
clean. Repeated rows each get the blob's findings. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.common import at_exit, broadcast_if_small, exists, packed, shared_folder, staged, text_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds, leftmost and without overlaps; a match counts if its ``group`` has ``least`` characters.

    ``screen`` holds in every text with a match that counts.
    """

    kind: str
    pattern: str
    group: int
    least: int
    screen: str


RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    # a run under 24 is no part of a longer one, so the pattern can ask for the length at once
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
)


def version_of(rules) -> str:
    """A rule version: it changes with any part of any rule."""
    return hashlib.sha256(repr([astuple(r) for r in rules]).encode()).hexdigest()[:16]


def addressed(docs: DataFrame, id_col: str, text_col: str, rules=RULES) -> DataFrame:
    """id, blob, and the text where a screen passes."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    screen = F.lit(False)
    for rule in rules:
        screen = screen | F.col("_text").rlike(rule.screen)
    return rows.select("_id", F.sha2(F.col("_text"), 256).alias("blob"), F.when(screen, F.col("_text")).alias("held"))


def matches(texts: DataFrame, rules=RULES) -> DataFrame:
    """blob, kind (index of the rule), start, end of every match that counts. One row a blob goes in."""
    def lengths(pieces: Column) -> Column:
        return F.transform(pieces, F.length)

    found = F.array(
        *(
            F.struct(
                F.lit(k).alias("kind"),
                F.lit(rule.least).alias("least"),
                lengths(F.split("text", rule.pattern, -1)).alias("gaps"),
                lengths(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias("whole"),
                lengths(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))).alias("part"),
            )
            for k, rule in enumerate(rules)
        )
    )
    by_rule = texts.select("blob", F.explode(found).alias("f")).where(F.size("f.whole") > 0)
    each = by_rule.select(
        "blob",
        F.col("f.kind").alias("kind"),
        F.col("f.least").alias("least"),
        F.posexplode(F.arrays_zip(F.col("f.gaps").alias("gap"), F.col("f.whole").alias("whole"), F.col("f.part").alias("part"))).alias("n", "m"),
    ).where(F.col("m.whole").isNotNull())
    up_to = Window.partitionBy("blob", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.whole")).over(up_to).cast("int")
    placed = each.select("blob", "kind", "least", "m", end.alias("end"))
    return placed.where(F.col("m.part") >= F.col("least")).select(
        "blob", "kind", (F.col("end") - F.col("m.whole")).alias("start"), "end"
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ledger: DataFrame | None = None, rules=RULES, rule_version: str | None = None):
    """(paths, findings, ledger rows to append).

    paths: id and blob of every row. findings: blob, spans (array of kind, start, end by start, then
    kind) of the blobs with any. The new ledger rows hold each span, or a row with kind -1 for a
    clean blob. The rule version is that of the rules where none is given.
    """
    rule_version = rule_version or version_of(rules)
    rows = staged(addressed(docs, id_col, text_col, rules), "secrets-blobs")
    paths = rows.select(F.col("_id").alias(id_col), "blob")
    blobs = rows.groupBy("blob").agg(F.min("_id").alias("_first"), F.max(F.col("held").isNotNull()).alias("_screened"))
    known = None
    if ledger is not None:
        met = blobs.select("blob")
        known = staged(ledger.where(F.col("rule_version") == rule_version).join(met, "blob", "left_semi").select("blob", "kind", "start", "end"), "secrets-known")
        blobs = blobs.join(known.select("blob").distinct(), "blob", "left_anti")
    picked = blobs.where("_screened")
    texts = (
        rows.where("held is not null")
        .withColumnRenamed("blob", "_blob")
        .join(picked, F.col("_first").eqNullSafe(F.col("_id")) & (F.col("blob") == F.col("_blob")))
        .select("blob", F.col("held").alias("text"))
        .dropDuplicates(["blob"])  # a repeated row can hold the blob's first id too
    )
    found = matches(texts, rules)
    found = staged(found, "secrets-found")
    fresh = blobs.select("blob").join(found, "blob", "left").select(
        "blob", F.lit(rule_version).alias("rule_version"), F.coalesce("kind", F.lit(-1)).alias("kind"), "start", "end"
    )
    spans = found if known is None else found.unionByName(known.where("kind >= 0")).distinct()
    by_blob = spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return paths, by_blob, fresh


#: Setting that names a ledger to keep between runs.
LEDGER_SETTING = "spark.folioforge.secrets.ledger"
LEDGER = "blob string, rule_version string, kind int, start int, end int"


def scan_with_ledger(docs: DataFrame, path: str, *, id_col: str = "doc_id", **how) -> tuple[DataFrame, DataFrame]:
    """(paths, findings) of scan() against the ledger table at ``path``, which may not be there yet.

    What is new is appended to the ledger. A run that breaks off before the append leaves the ledger as
    it was, and the next run scans those blobs again. Pairs that two runs append at once count once.
    """
    spark = docs.sparkSession
    known = spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else None
    paths, findings, fresh = scan(docs, id_col=id_col, ledger=known, **how)
    findings = staged(findings, "secrets-findings")
    fresh.write.mode("append").parquet(path)
    return paths, findings


def run_ledger(spark: SparkSession) -> str:
    """Where the ledger stands: the setting ``LEDGER_SETTING``, or a new table of this run in the shared folder."""
    named = spark.conf.get(LEDGER_SETTING, None)
    if named:
        return named
    own = f"{shared_folder(spark)}/ledger/{uuid.uuid4().hex}"
    at_exit(spark, own)
    return own


def joined_spans(spans: Column, rules=RULES) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules=RULES, ledger: str | None = None) -> DataFrame:
    """A row for each row of ``docs``: id, blob, n_<kind>, spans as an array. ``ledger``: its path, else ``run_ledger``."""
    path = ledger or run_ledger(docs.sparkSession)
    paths, findings = scan_with_ledger(docs, path, id_col=id_col, text_col=text_col, rules=rules)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    out = paths.join(findings, "blob", "left").select(id_col, "blob", F.coalesce("spans", none).alias("spans"))
    return out.select(
        id_col,
        "blob",
        *(F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(rules)),
        "spans",
    )


def _is(kind: int):
    return lambda s: s["kind"] == kind


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "<SECRET>", ledger: str | None = None) -> DataFrame:
    """``docs`` with every found span cut out of the text and ``mark`` put in its place.

    Overlapping spans are cut as one. Rows without findings are unchanged.
    """
    _, findings = scan_with_ledger(docs, ledger or run_ledger(docs.sparkSession), id_col=id_col, text_col=text_col)
    empty = F.lit(None).cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    cuts = staged(findings.select("blob", F.coalesce(merged, empty).alias("cuts")), "secrets-cuts")
    cuts = broadcast_if_small(cuts, cuts.agg(F.count("*") + F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()[0])  # blobs and cuts
    rows = packed(docs, text=F.col(text_col), key=F.sha2(text_of(text_col), 256))
    cut = rows.join(cuts, F.col("key") == F.col("blob"), "left").withColumn(
        "pieces",
        F.zip_with(
            F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["end"])),
            F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length("text"))),
            lambda a, b: F.substring(F.col("text"), a + 1, b - a),
        ),
    )
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join("pieces", mark))
    return cut.select(F.col("row").withField(text_col, text).alias("row")).select("row.*")
