"""Session and table helpers shared by the queries."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def get_session(app: str = "folioforge", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC timestamps; ``conf`` adds or overrides settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name; Spark's own readers resolve the path, so any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so they can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="folioforge-")) / "folioforge.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_work: dict[str, str] = {}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate files that all executors see: below spark.checkpoint.dir, or, on a local master without that, a temporary one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("no folder that all executors share: set spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not named and app not in _work:
        _work[app] = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    return f"{(named or _work[app]).rstrip('/')}/{name}-{uuid.uuid4().hex}"
