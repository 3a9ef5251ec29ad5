"""Incremental runs: new chapter files only, exactly once, through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.sources.files import chapter, file_number


def process_new_files(spark: SparkSession, folder: str, output: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Read the files that came since the last run, parse them as chapters, transform, append as Parquet.

    The checkpoint remembers files, so a run that breaks off goes on where it was.
    """
    files = spark.readStream.format("text").option("wholetext", "true").load(folder)
    rows = files.select(F.col("_metadata.file_name").alias("file"), "value").select(
        "file", file_number(F.col("file")).alias("number"), chapter(F.col("value")).alias("c")
    )
    rows = rows.select("file", "number", "c.title", "c.paragraphs")
    out = transform(rows) if transform else rows
    run = out.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
