"""Answers about stored layers from what is known without reading their rows: the dates of their
folders, and the counts in the footers of their files."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import seconds_of
from tickloom.operators.aggregate import freshness
from tickloom.operators.filters import SESSION_FALLBACK_SECONDS, trailing_range
from tickloom.sources.layers import read_layer
from tickloom.sources.raw import path_exists
from tickloom.sources.versions import DATE


def layer_dates(spark: SparkSession, path: str) -> DataFrame:
    """The dates that a layer has folders for, from the names of its files."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{DATE} date")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    named = F.regexp_extract("path", rf"/{DATE}=(\d+-\d\d-\d\d)/", 1)
    return files.select(F.try_to_timestamp(named, F.lit("yyyy-MM-dd")).cast("date").alias(DATE)).where(f"{DATE} is not null").distinct()


def _bounds(spark: SparkSession, path: str):
    return layer_dates(spark, path).agg(F.min(DATE).alias("first"), F.max(DATE).alias("last")).first()


def _dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_layer(spark, path, schema, more=[DATE])


def layer_freshness(spark: SparkSession, path: str, schema: T.StructType, ts: str) -> DataFrame:
    """First and last time of a layer; opens the folders of its first and last date only."""
    dates = _bounds(spark, path)
    rows = _dated(spark, path, schema)
    if dates["first"] is None:
        return freshness(rows, ts)
    return freshness(rows.where(F.col(DATE).isin(dates["first"], dates["last"])), ts)


def layer_trailing_range(
    spark: SparkSession, path: str, schema: T.StructType, time_range: str | None, ts: str, session_start: datetime | None = None
) -> DataFrame:
    """``filters.trailing_range`` of a stored layer; opens the folders of the range's dates only.

    The newest time lies in the last date's folder, so that alone tells where the range begins. Rows
    without a time are in no range, and in no dated folder.
    """
    rows, last = _dated(spark, path, schema), _bounds(spark, path)["last"]
    newest = None
    if last is not None:
        newest = rows.where(F.col(DATE) == F.lit(last)).agg(F.max(F.col(ts).cast("timestamp"))).first()[0]
    seconds = SESSION_FALLBACK_SECONDS if time_range == "session" else None if time_range in (None, "", "all") else seconds_of(time_range)
    if newest is not None and seconds is not None:
        start = newest - timedelta(seconds=seconds)
        if time_range == "session" and session_start is not None:
            # Compared as Spark would: a start with a zone as that moment, one without as UTC.
            moment = session_start.astimezone().replace(tzinfo=None) if session_start.tzinfo else session_start
            start = min(start, moment)
        rows = rows.where(F.col(DATE) >= F.to_date(F.lit(start) - F.expr("INTERVAL 1 DAY")))
    return trailing_range(rows.drop(DATE), time_range, ts, session_start)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a layer by the footers of its files; no row group is read."""
    if not path_exists(spark, path):
        return 0
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).first()["n"]


def layer_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(layer, rows, dates) of stored layers."""
    found = [(name, count_rows(spark, path), layer_dates(spark, path).count()) for name, path in paths.items()]
    return spark.createDataFrame(found, "layer string, rows long, dates long")
