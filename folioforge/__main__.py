"""Commands over folders of chapters: repair, combine, export, index, check, align."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import replace as R
from folioforge.functions import sequence as Q
from folioforge.functions import text as T
from folioforge.operators import align as A
from folioforge.plans import flows
from folioforge.session import get_session, ship
from folioforge.sources import files as S
from folioforge.sources import sinks as K
from folioforge.sources.named_files import write_files


def _chapters(spark: SparkSession, folder: str) -> DataFrame:
    files = S.one_file_a_number(S.text_files(spark, folder))
    return files.select("number", F.col("name").alias("file"), F.col("value").alias("text"), S.chapter(F.col("value")).alias("c")).select("number", "file", "text", "c.*")


def _range(text: str | None) -> tuple[int, int] | tuple[None, None]:
    if not text:
        return None, None
    low, _, high = text.partition("-")
    return int(low), int(high or low)


def repair(spark, a) -> int:
    glossary = flows.Glossary.read(spark, a.glossary)
    fixed, counts = R.repair(_chapters(spark, a.input).select("file", "text"), "text", "file", glossary.restore)
    if not a.dry_run:
        write_files(fixed.where("changed"), a.output, "file", "text", replace=True)
    print(counts.first().asDict())
    return 0


def combine(spark, a) -> int:
    rows = Q.range_blocks(_chapters(spark, a.input), "number", a.start, a.count)
    text = rows.withColumn("body", F.array_join("paragraphs", "\n\n"))
    blocks = K.combined(text, "block", "number", "body").withColumn("file", F.format_string("combined_%03d.txt", "block"))
    write_files(blocks, a.output, "file", "text", replace=True)
    return 0


def export(spark, a) -> int:
    low, high = _range(a.range)
    books = flows.package(_chapters(spark, a.input).select("number", "title", "paragraphs"), a.block_size, a.basename, a.author, low=low, high=high, kind=a.format)
    name = F.format_string(f"{a.basename.replace('%', '%%')}_%03d.{a.format}", "block")
    write_files(books.withColumn("file", name), a.output, "file", "content", replace=True)
    return 0


def index(spark, a) -> int:
    rows = S.text_files(spark, a.input).select(F.col("name").alias("file"), T.numbered_title(F.col("value"), F.col("name")).alias("t"))
    K.reader_index(rows.select("t.number", "t.title", "file").where("number is not null"), a.output)
    return 0


def check(spark, a) -> int:
    cn, en, es = (_chapters(spark, f).select("number", "text") for f in (a.cn, a.en, a.es))
    edges = S.json_map(S.text_files(spark, a.alignment)).select(F.col("key").cast("int").alias("en"), F.col("value").cast("int").alias("cn"))
    entries = F.explode(F.from_json("value", "map<string,struct<en:string,es:string>>")).alias("cn", "v")
    master = S.text_files(spark, a.master).select(entries).select("cn", "v.en", "v.es")
    for name, report in flows.check_translations(cn, en, es, edges, master).items():
        report.write.mode("overwrite").json(f"{a.output}/{name}")
    return 0


def align(spark, a) -> int:
    side = lambda f: _chapters(spark, f).select(F.lit("book").alias("book"), F.col("number").cast("long").alias("number"), "text")
    anchors = spark.read.schema("term string, translation string, weight int").json(a.anchors)
    A.align(side(a.en), side(a.cn), anchors).write.mode("overwrite").json(a.output)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioforge")
    commands = top.add_subparsers(dest="command", required=True)

    def add(run, *options: tuple) -> None:
        sub = commands.add_parser(run.__name__)
        for name, kind in options:
            if kind is bool:
                sub.add_argument(name, action="store_true")
            else:
                sub.add_argument(name, **kind)
        sub.set_defaults(run=run)

    need = {"required": True}
    add(repair, ("--input", need), ("--output", need), ("--glossary", need), ("--dry-run", bool))
    add(combine, ("--input", need), ("--output", need), ("--start", {"type": int, "default": 1}), ("--count", {"type": int, "default": 10}))
    add(export, ("format", {"choices": ["epub", "pdf"]}), ("--input", need), ("--output", need), ("--block-size", {"type": int, "default": 100}), ("--basename", {"default": "book"}), ("--author", {"default": ""}), ("--range", {}))
    add(index, ("--input", need), ("--output", need))
    add(check, *((f"--{n}", need) for n in ("cn", "en", "es", "alignment", "master", "output")))
    add(align, *((f"--{n}", need) for n in ("en", "cn", "anchors", "output")))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or get_session("folioforge")
    ship(session)
    return args.run(session, args)


if __name__ == "__main__":
    sys.exit(main())
