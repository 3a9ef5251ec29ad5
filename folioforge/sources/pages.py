"""Pages over HTTP as a data source: a batch read in parallel, and a stream that goes on where it was.

The catalogue is a text file of URLs that only grows; a page's position is its line. What is fetched lands in Parquet files of
``chunk`` positions before it is handed on, so a run that is killed and started again, from a checkpoint or from
scratch, fetches nothing that has landed. A batch read may be given a range of positions; pages outside it
aren't fetched. A stream's offsets are positions in the catalogue.

Options: catalogue and landing (paths or URIs that all executors see), fetcher ("module:function", which gives a fetcher as
in ``sources.http``), first and last (the range of a batch read, the last left out), chunk, delay (seconds between requests of one task) and attempts. A chunk is
a partition; the cluster's slots bound the requests at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import import_module
from time import sleep

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from folioforge.session import ship
from folioforge.sources.http import get, urlopen_fetcher
from folioforge.sources.named_files import opened

SCHEMA = "position long, url string, html string, error string"
_LANDED = pa.schema([("position", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("error", pa.string())])


def default_fetcher():
    return urlopen_fetcher()


@dataclass
class Stretch(InputPartition):
    """Positions of the catalogue with their URLs."""

    first: int
    urls: list[tuple[int, str]]


class _Pages:
    def __init__(self, options: dict[str, str]):
        self.catalogue, self.landing = options["catalogue"], options["landing"].rstrip("/")
        self.fetcher = options.get("fetcher", f"{__name__}:default_fetcher")
        self.chunk = max(1, int(options.get("chunk", 20)))
        self.range = int(options.get("first", 0)), int(options["last"]) if "last" in options else None
        self.delay, self.attempts = float(options.get("delay", 1.5)), int(options.get("attempts", 3))

    def urls(self) -> list[str]:
        """Whole lines of the catalogue; what has no line end yet is still being written."""
        system, path = opened(self.catalogue)
        with system.open_input_stream(path) as held:
            text = bytes(held.read()).decode("utf-8", "replace")
        return [line.strip() for line in text.split("\n")[:-1]]

    def stretches(self, wanted: list[tuple[int, str]]) -> list[Stretch]:
        """Chunks of the catalogue, each a partition; chunks lie at fixed places, whatever is asked for."""
        chunks: dict[int, list[tuple[int, str]]] = {}
        for position, url in wanted:
            chunks.setdefault(position // self.chunk, []).append((position, url))
        return [Stretch(k * self.chunk, own) for k, own in sorted(chunks.items())]

    def landed(self, first: int) -> dict[int, tuple]:
        """Pages of a chunk that have landed, in one file or several."""
        system, root = opened(self.landing)
        folder = f"{root}/{first:012d}"
        out: dict[int, tuple] = {}
        if system.get_file_info(folder).type == fs.FileType.Directory:
            for info in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
                if info.path.endswith(".parquet"):
                    for row in pq.read_table(info.path, filesystem=system).to_pylist():
                        out.setdefault(row["position"], tuple(row[c] for c in _LANDED.names))
        return out

    def land(self, first: int, rows: list[tuple]) -> None:
        """Written beside and moved, so no reader sees half a file."""
        system, root = opened(self.landing)
        folder, name = f"{root}/{first:012d}", uuid.uuid4().hex
        system.create_dir(folder, recursive=True)
        pq.write_table(pa.Table.from_pylist([dict(zip(_LANDED.names, r, strict=True)) for r in rows], schema=_LANDED), f"{folder}/{name}.part", filesystem=system)
        system.move(f"{folder}/{name}.part", f"{folder}/{name}.parquet")

    def fetch(self, stretch: Stretch) -> Iterator[tuple]:
        have = self.landed(stretch.first)
        left = [(p, u) for p, u in stretch.urls if p not in have or have[p][1] != u]
        module, _, name = self.fetcher.partition(":")
        fetcher = getattr(import_module(module), name)() if left else None
        fresh: dict[int, tuple] = {}
        for k, (position, url) in enumerate(left):
            if k:
                sleep(self.delay)
            try:
                fresh[position] = (position, url, get(url, fetcher, attempts=self.attempts), None)
            except Exception as error:
                fresh[position] = (position, url, None, str(error))
        good = [r for r in fresh.values() if r[3] is None]
        if good:  # what failed is asked for again in a later read
            self.land(stretch.first, good)
        for position, _ in stretch.urls:
            yield fresh.get(position) or have[position]


class PagesReader(DataSourceReader):
    """Filters aren't taken over: this version of Spark keeps a Python source's filters from one query over a table to the next."""

    def __init__(self, pages: _Pages):
        self.pages = pages

    def partitions(self) -> list[Stretch]:
        first, last = self.pages.range
        return self.pages.stretches([(k, u) for k, u in enumerate(self.pages.urls()) if u and first <= k and (last is None or k < last)])

    def read(self, partition: Stretch) -> Iterator[tuple]:
        return self.pages.fetch(partition)


class PagesStream(DataSourceStreamReader):
    def __init__(self, pages: _Pages):
        self.pages = pages

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        """The catalogue's end."""
        return {"position": len(self.pages.urls())}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        urls = self.pages.urls()[: end["position"]]
        return self.pages.stretches([(k, u) for k, u in enumerate(urls) if k >= start["position"] and u])

    def read(self, partition: Stretch) -> Iterator[tuple]:
        return self.pages.fetch(partition)

    def commit(self, end: dict) -> None:
        pass


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folioforge_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagesReader:
        return PagesReader(_Pages(self.options))

    def streamReader(self, schema) -> PagesStream:
        return PagesStream(_Pages(self.options))


def register(spark: SparkSession) -> str:
    """Makes the source known; the name of its format."""
    ship(spark)
    spark.dataSource.register(Pages)
    return Pages.name()
