"""What streaming queries report, kept as tables: offsets reached and counts observed.

The sources' ends come with every report, so a backlog needs no look at the messages.
"""

from __future__ import annotations

import json
import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from skytide.session import qualified
from skytide.sources.append_log import AppendLog, Rows

OFFSETS_SCHEMA = "query string, batch bigint, at timestamp, topic string, partition int, start bigint, end bigint, latest bigint"
COUNTS_SCHEMA = "query string, batch bigint, at timestamp, name string, metric string, value double"


def _reduce_offsets(rows: Rows) -> Rows:
    """The last report of each query and topic partition, with the first start."""
    last: dict[tuple, dict] = {}
    for row in rows:
        key = (row["query"], row["topic"], row["partition"])
        before = last.get(key, row)
        newer = row if row["at"] >= before["at"] else before
        last[key] = {**newer, "start": min(before["start"], row["start"]), "latest": max(before["latest"], row["latest"])}
    return list(last.values())


def _reduce_counts(rows: Rows) -> Rows:
    """The last report of each batch: a batch that was repeated counts once."""
    last: dict[tuple, dict] = {}
    for row in sorted(rows, key=lambda r: r["at"]):
        last[row["query"], row["batch"], row["name"], row["metric"]] = row
    return list(last.values())


def offsets_log(spark: SparkSession, path: str) -> AppendLog:
    return AppendLog(f"{qualified(spark, path).rstrip('/')}/offsets", OFFSETS_SCHEMA, _reduce_offsets)


def counts_log(spark: SparkSession, path: str) -> AppendLog:
    return AppendLog(f"{qualified(spark, path).rstrip('/')}/counts", COUNTS_SCHEMA, _reduce_counts)


def per_partition(offsets: str | None) -> dict[tuple[str, int], int]:
    """Offsets as Kafka's source reports them; those of other kinds of sources are left out."""
    parsed = json.loads(offsets) if (offsets or "").startswith("{") else {}  # before the first batch there are none
    return {
        (topic, int(p)): o
        for topic, of_topic in parsed.items() if isinstance(of_topic, dict)
        for p, o in of_topic.items() if p.isdigit() and isinstance(o, int)
    }


class ProgressLog(StreamingQueryListener):
    """Keeps the reports of all queries of a session while it is attached (``with``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.offsets, self.counts = spark, offsets_log(spark, path), counts_log(spark, path)
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        at = datetime.fromisoformat(report.timestamp.replace("Z", "+00:00"))
        about = {"query": str(report.id), "batch": report.batchId, "at": at}
        rows = []
        for source in report.sources:
            start, end = per_partition(source.startOffset), per_partition(source.endOffset)
            latest = per_partition(source.latestOffset)
            for key in sorted({*end, *latest}):
                reached = end.get(key, start.get(key, 0))
                rows.append({**about, "topic": key[0], "partition": key[1], "start": start.get(key, reached if start else 0), "end": reached, "latest": max(latest.get(key, reached), reached)})
        self.offsets.append(rows)
        counts = []
        for name, observed in report.observedMetrics.items():
            for metric, value in observed.asDict().items():
                if isinstance(value, (int, float)):
                    counts.append({**about, "name": name, "metric": metric, "value": float(value)})
        self.counts.append(counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query, timeout: float = 60.0) -> None:
        """Until all reports of a query that has ended are kept: they arrive a little later."""
        run = str(query.runId)
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, timeout):
                raise TimeoutError(f"no end reported of query run {run}")


def progress_bounds(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """First offset any query began at, and one past the last offset known, of every
    topic partition that queries have reported."""
    rows = offsets_log(spark, path).read(spark)
    if topics is not None:
        rows = rows.filter(F.col("topic").isin(*topics))
    return rows.groupBy("topic", "partition").agg(F.min("start").alias("lo"), F.max("latest").alias("hi"))


def observed_counts(spark: SparkSession, path: str) -> DataFrame:
    """What queries have observed of each batch: ``query, batch, at, name, metric, value``."""
    rows = counts_log(spark, path).read(spark)
    return rows.groupBy("query", "batch", "name", "metric").agg(F.max("at").alias("at"), F.max_by("value", "at").alias("value"))
