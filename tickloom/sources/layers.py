"""Layer tables, session snapshots, exports, retention and the small JSON tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.filters import newest, select_keys, trailing_range
from tickloom.sources.raw import move_path, path_exists, raw_files, remove_path, replace_path
from tickloom.sources.versions import BATCH, DATE

# CSV keeps microseconds and the offset
CSV = {"header": True, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_layer(df: DataFrame, path: str, ts: str, batch_id: int | None = None, mode: str = "append") -> None:
    """Parquet partitioned by date of ``ts``.

    ``rebalance`` sizes the files and splits a date that is much larger than the others. With
    a ``batch_id`` the batch owns its folder and a repeated batch replaces it.
    """
    dated = df.withColumn(DATE, F.to_date(ts)).hint("rebalance", DATE)
    if batch_id is not None:
        dated.write.mode("overwrite").partitionBy(DATE).parquet(f"{path}/{BATCH}={batch_id}")
    elif mode == "overwrite_dates":
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)
    else:
        dated.write.mode(mode).partitionBy(DATE).parquet(path)


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType, since: datetime | None = None, more: Sequence[str] = ()
) -> DataFrame:
    """A layer with its declared columns; no rows if the path is missing or holds no table.

    A column that a batch does not have is null in its rows alone. ``since`` prunes the date
    folders before it; ``more`` names partition columns (``dt``, ``batch_id``) to keep.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    # The declared schema, not that of one footer: batches may differ in their columns.
    stored = spark.read.schema(schema).parquet(path)
    if since is not None and DATE in stored.columns:
        stored = stored.where(F.col(DATE) >= F.lit(since.date()))
    kept = [f.name for f in schema.fields]
    return stored.select(*kept, *[c for c in more if c in stored.columns])


def save_session(gold: DataFrame, silver: DataFrame, path: str, taken_at: datetime) -> None:
    """Snapshot of gold, or of silver if gold is empty, as CSV files of one session."""
    df = silver if gold.isEmpty() else gold
    name = taken_at.strftime("session_%Y%m%d_%H%M%S")
    df.write.mode("overwrite").options(**CSV).csv(f"{path}/session={name}")


def list_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Names of the stored sessions, newest first. Reads file names, no contents."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "session string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option(
        "recursiveFileLookup", "true").load(path).select("path")
    name = F.regexp_extract("path", r"session=([^/]+)/", 1)
    return files.select(name.alias("session")).distinct().orderBy(F.col("session").desc())


def load_session(spark: SparkSession, path: str, session: str, schema: T.StructType, limit: int = 500) -> DataFrame:
    """The newest ``limit`` rows of one session."""
    where = f"{path}/session={session}"
    if not path_exists(spark, where):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).options(**CSV).csv(where)
    ts = "window_start" if "window_start" in rows.columns else "fetched_at"
    return newest(rows, limit, ts, ["coin_id"])


def export_selected(df: DataFrame, keys: Sequence[str], ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Overview export: the chosen keys in time order, whatever range is shown; no keys, no rows."""
    return select_keys(df, keys, empty_means="none").orderBy(ts, *tiebreak)


def export_range(
    df: DataFrame, time_range: str, keys: Sequence[str] | None = None, ts: str = "ts",
    session_start: datetime | None = None,
) -> DataFrame:
    """Explorer export: the range over all keys, then the chosen keys (none chosen: all)."""
    return select_keys(trailing_range(df, time_range, ts, session_start), keys)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, with ISO times."""
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"}
    return df.select(F.to_json(F.struct("*"), {**iso, "ignoreNullFields": "false"}).alias("record"))


def retain(df: DataFrame, ts: str, keep_hours: float = 1, now: datetime | Column | None = None) -> DataFrame:
    """Rows not older than ``keep_hours``. ``now`` is the clock unless it is given."""
    kind = dict(df.dtypes)[ts]
    clock = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    keep = F.make_interval(secs=F.lit(keep_hours * 3600.0).cast("decimal(18,6)"))
    return df.where(F.col(ts) >= (clock - keep).cast(kind))


def expired_files(spark: SparkSession, path: str, keep_hours: float = 1, now: datetime | None = None) -> DataFrame:
    """Raw files last modified before the retention limit (path, modified_at)."""
    clock = F.current_timestamp() if now is None else F.lit(now)
    limit = clock - F.make_interval(secs=F.lit(keep_hours * 3600.0).cast("decimal(18,6)"))
    return raw_files(spark, path).where(F.col("modified_at") < limit).select("path", "modified_at")


def apply_retention(
    spark: SparkSession, path: str, keep_hours: float = 1, now: datetime | None = None, archive: str | None = None
) -> int:
    """Delete the expired raw files, or move them to ``archive``; how many there were.

    Only names pass through the driver, one after another.
    """
    n = 0
    for row in expired_files(spark, path, keep_hours, now).toLocalIterator():
        if archive:
            move_path(spark, row["path"], archive)
        else:
            remove_path(spark, row["path"])
        n += 1
    return n


def read_json_table(spark: SparkSession, path: str, schema: T.StructType, array: bool = False) -> DataFrame:
    """A JSON-lines table (rules, history), or with ``array`` one JSON array per file; missing or
    unreadable means no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("multiLine", array).option("mode", "DROPMALFORMED").json(path)
    return rows.where(F.coalesce(*[F.col(c).cast("string") for c in schema.fieldNames()]).isNotNull())


def write_json_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines. Overwriting writes a new folder first, so ``df`` may read the table itself and a
    failed write leaves it as it was. Tables with several writers are ``versions.VersionedTable``."""
    if mode != "overwrite":
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)
        return
    fresh = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.option("ignoreNullFields", "false").json(fresh)
    replace_path(df.sparkSession, fresh, path)
