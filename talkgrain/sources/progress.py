"""What a run reads and writes, counted while it runs: no figure takes a scan of its own."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkgrain.functions.text import stripped
from talkgrain.sources.jsonl import parsed_line


def duration(seconds: float) -> str:
    """Hours and minutes, minutes and seconds, or seconds."""
    whole = max(round(seconds), 0)
    if whole >= 3600:
        return f"{whole // 3600}h {whole % 3600 // 60}m"
    return f"{whole // 60}m {whole % 60}s" if whole >= 60 else f"{whole}s"


@dataclass
class Progress:
    """How far a run is, as a line for people."""

    target: int
    clock: Callable[[], float] = time.monotonic
    done: int = 0
    errors: int = 0
    started: float = field(init=False)

    def __post_init__(self) -> None:
        self.started = self.clock()

    def line(self) -> str:
        spent = max(self.clock() - self.started, 0.0)
        each = spent / self.done if self.done else 0.0
        left = duration(max(self.target - self.done, 0) * each) if self.done else "calculating"
        return f"Generated {self.done}/{self.target} records | errors {self.errors} | elapsed {duration(spent)} | avg {each:.1f}s/record | ETA {left}"


def tasks(spark: SparkSession, group: str) -> tuple[int, int]:
    """Tasks that have ended, and all tasks known so far, of a group of jobs."""
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) if (info := tracker.getJobInfo(job)) for s in info.stageIds}
    known = [info for s in stages if (info := tracker.getStageInfo(s))]
    return sum(s.numCompletedTasks for s in known), sum(s.numTasks for s in known)


@contextmanager
def watched(spark: SparkSession, group: str, say: Callable[[int, int, float], None], every: float = 1.0) -> Iterator[None]:
    """Tell ``say`` every so often, and at the end, how many tasks of the jobs inside have ended, how many there are, and how many seconds have passed."""
    spark.sparkContext.setJobGroup(group, group)
    began, over = time.monotonic(), threading.Event()

    def watch() -> None:
        while not over.wait(every):
            say(*tasks(spark, group), time.monotonic() - began)

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()
        say(*tasks(spark, group), time.monotonic() - began)
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what its next full run will have counted; ``get`` waits for it."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def write_counted(df: DataFrame, path: str, **counts: Column) -> dict[str, Any]:
    """Write a table as JSON lines, and say how many rows it had, with further counts, from the same pass."""
    rows, seen = observed(df, "written", rows=F.count(F.lit(1)), **counts)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get


def split_lines(spark: SparkSession, path: str, out: str) -> dict[str, Any]:
    """Lines of text files as they are, those that are JSON under ``out/status=record``, the others under ``out/status=error``, in one pass.

    Gives ``lines, records, errors, blanks`` and the seconds that it took. Blank lines are written nowhere.
    """
    began = time.monotonic()
    value = F.col("value")
    status = F.when(stripped(value) == "", "blank").when(parsed_line(value).isNull(), "error").otherwise("record")
    rows = spark.read.text(path).select("value", status.alias("status"))
    of = {f"{k}s": F.count_if(F.col("status") == k) for k in ("record", "error", "blank")}
    told, seen = observed(rows, "lines", lines=F.count(F.lit(1)), **of)
    told.where("status <> 'blank'").write.mode("overwrite").partitionBy("status").text(out)
    return seen.get | {"seconds": time.monotonic() - began}
