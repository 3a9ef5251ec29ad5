"""Progress of a job while it runs, and exact counts of what it wrote, without a pass of their own.

Rate and rest come from the finished tasks of the job's stages; the counts are metrics that the job gathers on
its way, so they are those of its output.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Report:
    """Tasks done of those known so far, tasks a minute, and seconds to go (None before the first task has ended)."""

    done: int
    known: int
    seconds: float

    @property
    def a_minute(self) -> float:
        return 60 * self.done / self.seconds if self.seconds > 0 else 0.0

    @property
    def rest(self) -> float | None:
        return self.seconds * (self.known - self.done) / self.done if self.done else None

    def __str__(self) -> str:
        rest = "" if self.rest is None else f", {self.rest:.0f} s to go"
        return f"{self.done}/{self.known} tasks, {self.a_minute:.1f} a minute{rest}"


@dataclass
class Progress:
    """Reports of a job group, and the counts of the tables it watches."""

    spark: SparkSession
    group: str
    began: float = field(default_factory=time.time)
    watched: dict[str, Observation] = field(default_factory=dict)
    _seen: dict[int, tuple[int, int]] = field(default_factory=dict)

    def watch(self, df: DataFrame, name: str = "rows", **counts: Column) -> DataFrame:
        """``df``; when it has been written, ``counts(name)`` has its rows and what else is counted, e.g. failed=F.count_if(...)."""
        held = self.watched[name] = Observation(f"{self.group}-{name}")
        return df.observe(held, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in counts.items()))

    def counts(self, name: str = "rows") -> dict[str, int]:
        return dict(self.watched[name].get)

    def report(self) -> Report:
        tracker = self.spark.sparkContext.statusTracker()
        for job in tracker.getJobIdsForGroup(self.group):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                known = tracker.getStageInfo(stage)
                if known:  # a stage that is forgotten keeps its last numbers, one that a finished job left out has none to do
                    done = known.numCompletedTasks
                    self._seen[stage] = (done, done if info.status == "SUCCEEDED" else known.numTasks)
        done, total = (sum(x[k] for x in self._seen.values()) for k in (0, 1))
        return Report(done, total, time.time() - self.began)


@contextmanager
def progress(spark: SparkSession, say: Callable[[Report], None] = print, *, every: float = 5.0) -> Iterator[Progress]:
    """Says how far the jobs of this thread are, every so many seconds and at the end."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.jobGroup.id")
    own = Progress(spark, f"progress-{uuid.uuid4().hex}")
    context.setJobGroup(own.group, "progress")
    over = threading.Event()

    def tell() -> None:
        while not over.wait(every):
            say(own.report())

    teller = threading.Thread(target=tell, daemon=True)
    teller.start()
    try:
        yield own
    finally:
        over.set()
        teller.join()
        context.setLocalProperty("spark.jobGroup.id", before)
        say(own.report())
