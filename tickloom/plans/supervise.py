"""Cycles and streams under supervision: what each did is a row of a table, and a failure is one too.

A failed batch cycle is logged and tried again with the files that have come meanwhile; a failed stream
is started again from its checkpoint.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.plans.medallion import run_cycle
from tickloom.sources.raw import path_exists

CYCLE = T.StructType([
    T.StructField("batch_id", T.LongType(), True), T.StructField("attempt", T.LongType(), True),
    T.StructField("status", T.StringType(), True), T.StructField("started_at", T.TimestampType(), True),
    T.StructField("seconds", T.DoubleType(), True), T.StructField("bronze_rows", T.LongType(), True),
    T.StructField("silver_rows", T.LongType(), True), T.StructField("gold_windows", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
])
PROGRESS = T.StructType([
    T.StructField("query", T.StringType(), True), T.StructField("run_id", T.StringType(), True),
    T.StructField("event", T.StringType(), True), T.StructField("batch_id", T.LongType(), True),
    T.StructField("at", T.TimestampType(), True), T.StructField("input_rows", T.LongType(), True),
    T.StructField("state_rows", T.LongType(), True), T.StructField("dropped_late", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), True), T.StructField("observed", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])


class EventLog:
    """Rows as JSON files of their own, written without a Spark job; names sort by time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def add(self, **row) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json")
        stream = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(where, False)
        try:
            plain = {k: v.isoformat() if isinstance(v, datetime) else v for k, v in row.items()}
            stream.write((json.dumps(plain) + "\n").encode())
        finally:
            stream.close()

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("pathGlobFilter", "*.json").json(self.path)


def short(error: BaseException, size: int = 2000) -> str:
    return f"{type(error).__name__}: {error}"[:size]


def supervised_cycle(
    spark: SparkSession, raw_path: str, out_path: str, batch_id: int, log_path: str, attempt: int = 0,
    cycle: Callable[..., bool] = run_cycle, **how,
) -> str:
    """One cycle, logged with the rows of each layer: "done", "idle" (no new file) or "failed". An error
    ends up in the log, not at the caller."""
    counts: dict[str, int] = {}
    log, started, clock = EventLog(spark, log_path, CYCLE), datetime.now(timezone.utc), time.monotonic()
    error = None
    try:
        status = "done" if cycle(spark, raw_path, out_path, batch_id, counts=counts, **how) else "idle"
    except Exception as failure:
        status, error = "failed", short(failure)
    log.add(
        batch_id=batch_id, attempt=attempt, status=status, started_at=started, seconds=time.monotonic() - clock, error=error,
        **{name: 0 if status == "idle" else counts.get(name) for name in ("bronze_rows", "silver_rows", "gold_windows")},
    )
    return status


def run_cycles(
    spark: SparkSession, raw_path: str, out_path: str, log_path: str, cycles: int, pause: float = 10.0, first: int = 0, **how,
) -> int:
    """So many cycles, a pause after each; the batch id that comes next. A failed cycle does not end
    the loop: the next one repeats its batch."""
    batch_id, attempt = first, 0
    for turn in range(cycles):
        status = supervised_cycle(spark, raw_path, out_path, batch_id, log_path, attempt, **how)
        batch_id, attempt = (batch_id + 1, 0) if status == "done" else (batch_id, attempt + 1 if status == "failed" else 0)
        if turn < cycles - 1:
            time.sleep(pause)
    return batch_id


class ProgressListener(StreamingQueryListener):
    """Micro-batches and ends of all streams of the session as rows of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = EventLog(spark, path, PROGRESS)

    def onQueryStarted(self, event) -> None:
        self.log.add(query=event.name or str(event.id), run_id=str(event.runId), event="started", at=datetime.now(timezone.utc))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.log.add(
            query=p.name or str(p.id), run_id=str(p.runId), event="progress", batch_id=p.batchId, at=datetime.now(timezone.utc),
            input_rows=p.numInputRows, state_rows=sum(s.numRowsTotal for s in p.stateOperators),
            dropped_late=sum(s.numRowsDroppedByWatermark for s in p.stateOperators), seconds=p.batchDuration / 1000,
            observed=json.dumps({name: row.asDict() for name, row in p.observedMetrics.items()}, default=str),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log.add(query=str(event.id), run_id=str(event.runId), event="failed" if event.exception else "ended",
                     at=datetime.now(timezone.utc), error=event.exception)


def keep_running(start: Callable[[], StreamingQuery], tries: int = 5, pause: float = 10.0) -> StreamingQuery:
    """Start a stream, and start it again from its checkpoint when it fails, at most ``tries`` times in
    all; the last failure is raised. Returns the query once it has ended well."""
    for attempt in range(tries):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            if attempt == tries - 1:
                raise
            time.sleep(pause)
    raise AssertionError("unreachable")
