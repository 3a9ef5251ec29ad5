"""Scans of text, JSON and JSON Lines files; any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions.rules import CHAPTER_END, CHAPTER_TITLE
from folioforge.functions.text import is_skipped_line, lines, rstrip, strip

SCRAPE_INDEX = "number int, title string, url string, file string, length int, retrieved_at string"
TRANSLATION_INDEX = (
    "number int, title_en string, title_es string, file_en string, file_es string, input_dir string, output_dir string, "
    "length_en int, length_es int, model string, adapter_name string, translated_at string"
)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, value): a row for each file, whole."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value")


def file_number(name: Column, pattern: str = r"(\d+)") -> Column:
    """The first number in a file name; null where there is none."""
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("int")


def numbered_files(files: DataFrame, pattern: str = r"(\d+)", low: int | None = None, high: int | None = None) -> DataFrame:
    """Files with a number in their name, within low..high (either way round)."""
    out = files.withColumn("number", file_number(F.col("name"), pattern)).where("number is not null")
    if low is not None and high is not None:
        out = out.where(F.col("number").between(min(low, high), max(low, high)))
    return out


def one_file_a_number(files: DataFrame) -> DataFrame:
    """Of the files with one number the one that is no draft, then the first by path."""
    numbered = numbered_files(files, r"^(?:cn_)?(\d+)")
    order = Window.partitionBy("number").orderBy(F.contains(F.lower("name"), F.lit("draft")), "path")
    return numbered.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def chapter(value: Column) -> Column:
    """struct(title, paragraphs): first line, then from the third line on; blank lines end paragraphs.

    Lines of a paragraph lose their right end and join with a space.
    """
    all_lines = lines(value)
    body = F.slice(all_lines, 3, F.greatest(F.size(all_lines), F.lit(1)))
    marked = F.array_join(F.transform(body, lambda x: F.when(strip(x) == "", F.lit("\x00")).otherwise(rstrip(x))), " ")
    parts = F.filter(F.transform(F.split(marked, "\x00", -1), lambda p: F.regexp_replace(p, "^ | $", "")), lambda p: p != "")
    return F.struct(F.coalesce(strip(F.get(all_lines, F.lit(0))), F.lit("")).alias("title"), parts.alias("paragraphs"))


def raw_chapter(value: Column, notes: list[str] = ()) -> Column:
    """struct(title, paragraphs) of a raw file: stops at the end marker; drops blank lines, indented notes
    (ideographic space) and metadata; the first chapter line is the title, later ones are paragraphs. Bracketed
    remarks of the title that begin with one of the patterns ``notes`` go."""

    def once(x: Column, body: Callable[[Column], Column]) -> Column:  # a step that is named often is worked out once
        return F.get(F.transform(F.array(x), body), F.lit(0))

    def before(kept: Column) -> Column:
        stop = F.array_position(F.transform(kept, lambda x: x["line"].rlike(CHAPTER_END)), F.lit(True))
        return once(stop, lambda k: F.when(k > 0, F.slice(kept, 1, F.greatest(k.cast("int") - 1, F.lit(0)))).otherwise(kept))

    def split(good: Column, at: Column) -> Column:
        title = F.get(good, at - 1)
        if notes:
            title = F.regexp_replace(title, rf"[（(](?:{'|'.join(notes)})[^）)]*[）)]", "")
        title = F.coalesce(strip(title), F.lit(""))
        rest = F.when(at > 0, F.concat(F.slice(good, 1, F.greatest(at - 1, F.lit(0))), F.slice(good, at + 1, F.greatest(F.size(good), F.lit(1))))).otherwise(good)
        return F.struct(F.when(at > 0, title).otherwise("").alias("title"), rest.alias("paragraphs"))

    def parts(good: Column) -> Column:
        at = F.array_position(F.transform(good, lambda x: x.rlike(CHAPTER_TITLE)), F.lit(True)).cast("int")
        return once(at, lambda k: split(good, k))

    kept = F.transform(lines(value), lambda x: F.struct(x.alias("raw"), strip(x).alias("line")))
    keeps = lambda x: (x["line"] != "") & ~F.contains(x["raw"], F.lit("　")) & ~is_skipped_line(x["line"])
    good = F.transform(F.filter(once(kept, before), keeps), lambda x: x["line"])
    return once(good, parts)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON Lines file; blank and malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_map(files: DataFrame, wrapper: str | None = None, field: str | None = None) -> DataFrame:
    """(path, ord, key, value) of files that hold one JSON object; an outer ``wrapper`` is taken off where it is.

    ``field`` takes the object below it. ``ord`` is the place in the file.
    """
    body = F.col("value")
    for name in (wrapper, field):
        if name:
            body = F.coalesce(F.get_json_object(body, f"$.{name}"), body if name == wrapper else F.lit("{}"))
    entries = F.map_entries(F.from_json(body, "map<string,string>"))
    return files.select("path", F.posexplode(entries).alias("ord", "e")).select("path", "ord", "e.key", "e.value")


def bilingual_chunks(files: DataFrame, separator: str = r"={10,}", pattern: str = r"Chapter (\d+)") -> DataFrame:
    """(number, text) of files that hold chapters between lines of "="; of equal numbers the last wins."""
    pieces = files.select("path", F.posexplode(F.split("value", separator, -1)).alias("pos", "text"))
    found = pieces.withColumn("number", F.nullif(F.regexp_extract("text", pattern, 1), F.lit("")).try_cast("int"))
    return found.where("number is not null").groupBy("number").agg(F.max_by(strip(F.col("text")), F.struct("path", "pos")).alias("text"))


def absolute_url(base: Column, link: Column) -> Column:
    """A link from a page made absolute: whole, from the host, or from the page's folder."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    folder = F.concat(root, F.regexp_extract(F.concat(base, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*((?:/[^?#]*/)?)", 1))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .otherwise(F.concat(F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/"))), link))
    )


def read_env(text: str) -> dict[str, str]:
    """Settings of an .env file: comments and blank lines go, "export" and quotes are taken off."""
    out = {}
    for line in text.lstrip("﻿").splitlines():
        line = line.strip()
        if not line or line.startswith("#") or "=" not in line:
            continue
        key, _, value = line.removeprefix("export ").partition("=")
        out[key.strip()] = value.strip().strip("\"'")
    return out


def read_yaml(text: str) -> dict:
    """Settings of a YAML file, as nested dictionaries; an empty file has none. Needs PyYAML."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("settings in YAML need the package PyYAML") from error
    return yaml.safe_load(text) or {}
