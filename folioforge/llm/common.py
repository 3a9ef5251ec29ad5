"""Shared helpers: the word pattern, the shared work folder, staged tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word is a run of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
ROWS = 128

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where the cluster names one.

    Where it is unset, a local master gets a temporary folder of its own and any other master a
    folder below the warehouse, if that isn't on a machine's own disk; else there is no shared folder, which is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="folioforge-")
        else:
            _own_folder[app] = below_warehouse(spark)
    return _own_folder[app]


def below_warehouse(spark: SparkSession) -> str:
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if _at(spark, warehouse)[0].getUri().getScheme() == "file":
        raise ValueError(f"no folder that all executors share: set spark.checkpoint.dir (the warehouse, {warehouse}, is a local folder)")
    return warehouse.rstrip("/") + "/_folioforge"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; (what reads it back, path). It goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.exists(at)


def at_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the driver's JVM ends."""
    system, at = _at(spark, path)
    system.deleteOnExit(at)


def discard(spark: SparkSession, path: str) -> None:
    system, at = _at(spark, path)
    system.delete(at, True)


_tables: list[str] = []


def staged(df: DataFrame, name: str, *, release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts the lineage and survives lost executors.

    ``release`` has the JVM look for shuffles that nothing refers to any more and delete their files.
    """
    out, path = stored(df, name)
    _tables.append(path)
    if release:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; what builds on them is to be written by then."""
    mark = len(_tables)
    try:
        yield
    finally:
        for path in _tables[mark:]:
            discard(spark, path)
        del _tables[mark:]


def text_of(column: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(df: DataFrame) -> DataFrame:
    """For a join in which no side is to be broadcast. Spark takes an exploded table for as small as what it is made of, so
    left to itself it may send all of its rows through the driver."""
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """A broadcast hint only where the counted rows stay below ``most``; else Spark shuffles, whatever size it takes a side for."""
    return F.broadcast(df) if rows <= most else shuffled(df)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``docs`` whole, as the struct "row", and the named columns: no name of theirs can clash."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, *(c.alias(name) for name, c in columns.items()))


def map_rows(rows: DataFrame, carried: list[str], start: Callable, made: str) -> DataFrame:
    """The columns ``carried`` as they are, and columns made in Python of the others.

    ``start()`` runs once a task and returns a function from the other columns, each a list, to the
    columns of the schema ``made``, each a list or an array, with a value for every row; or to (row
    numbers, columns), where the results are any number of rows that repeat those rows' carried columns;
    or to an iterator of such parts.
    Carried columns stay in Arrow: ids of any type, beside nulls too, come back as they went in. Python
    sees ROWS rows at a time, which bounds what it holds besides a batch.
    """
    new = StructType.fromDDL(made)
    schema = StructType([rows.schema[c] for c in carried] + new.fields)
    others = [k for k, c in enumerate(rows.columns) if c not in carried]
    places = [rows.columns.index(c) for c in carried]
    kinds = [to_arrow_schema(StructType([f])).field(0).type for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            found = work(*(batch.column(k).to_pylist() for k in others))
            for part in found if isinstance(found, Iterator) else [found]:
                kept = [batch.column(k) for k in places]
                if isinstance(part, tuple):
                    at, part = part
                    kept = [c.take(pa.array(at, type=pa.int64())) for c in kept]
                values = [pa.array(v, type=t) for v, t in zip(part, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(kept + values, names=schema.names)

    return rows.mapInArrow(run, schema)
