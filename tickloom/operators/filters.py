"""Key selection, time ranges, minimum history, top-k."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.columns import micros, seconds_of, shift_minutes
from tickloom.scale import KeyProfile, join_stats, ordered, profile
from tickloom.schemas import SERIES, Series

SESSION_FALLBACK_SECONDS = 1800


def select_keys(
    df: DataFrame, keys: Sequence[str] | DataFrame | None, key: str = "coin_id", empty_means: str = "all"
) -> DataFrame:
    """Rows of the chosen keys. ``empty_means`` is "all" or "none" (the export).

    A list becomes an IN filter that reaches the scan; a DataFrame becomes a semi join.
    """
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key), key, "left_semi")
    if not keys:
        return df if empty_means == "all" else df.where(F.lit(False))
    return df.where(F.col(key).isin(list(keys)))


def trailing_range(
    df: DataFrame, time_range: str | None, ts: str = "ts", session_start: datetime | None = None,
    tz_offset: int = 0, since: datetime | None = None,
) -> DataFrame:
    """Rows of the last "30m", "6h", ... before the newest row of the whole table.

    "session" keeps rows from ``session_start`` on, or the last half hour if there are none.
    "all", None and unreadable labels keep everything. The cutoff is a scalar subquery, so
    it is computed once and the comparison is an ordinary filter on the scan. ``since`` adds
    a literal lower bound that prunes date partitions.
    """
    if since is not None:
        df = df.where(F.col(ts) >= F.lit(since))
    kind = dict(df.dtypes)[ts]
    newest = F.max(micros(ts))
    if time_range == "session":
        start = micros(F.lit(session_start))
        fallback = newest - SESSION_FALLBACK_SECONDS * 1_000_000
        cutoff = F.when(newest >= start, start).otherwise(fallback)
    elif time_range in (None, "", "all") or seconds_of(time_range) is None:
        cutoff = None
    else:
        cutoff = newest - seconds_of(time_range) * 1_000_000
    if cutoff is not None:
        bound = df.agg(F.timestamp_micros(cutoff).cast(kind).alias("cutoff"))
        df = df.where(F.col(ts) >= bound.scalar())
    return df.withColumn(ts, shift_minutes(ts, tz_offset)) if tz_offset else df


def min_history(
    df: DataFrame, rows: int, by: Series = SERIES, size: KeyProfile | None = None
) -> DataFrame:
    """Rows of the keys that have at least ``rows`` rows."""
    size = size or profile(df, by)
    if not size.hot:
        # partitioned and sorted like the row windows that follow: no extra shuffle or sort
        whole = ordered([by.key], by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        total = F.count(F.lit(1)).over(whole)
        return df.withColumn("_total", total).where(F.col("_total") >= rows).drop("_total")
    enough = df.groupBy(by.key).agg(F.count(F.lit(1)).alias("_total")).where(F.col("_total") >= rows)
    return join_stats(df, enough.select(by.key), by.key, size, "left_semi")


def last_n_per_key(df: DataFrame, n: int, by: Series = SERIES) -> DataFrame:
    """The newest n rows of every key; the rank filter runs map-side first."""
    rank = F.row_number().over(ordered([by.key], by, newest_first=True))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def newest(df: DataFrame, n: int, ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest n rows of the whole table (top-k, no full sort)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak]).limit(n)


def explore(
    df: DataFrame, keys: Sequence[str] | None = None, time_range: str = "all", ts: str = "ts",
    tiebreak: Sequence[str] = (), tz_offset: int = 0, limit: int = 500,
    session_start: datetime | None = None,
) -> DataFrame:
    """Table view: range over all keys, then key choice, then the newest ``limit`` rows."""
    ranged = trailing_range(df, time_range, ts, session_start, tz_offset)
    return newest(select_keys(ranged, keys), limit, ts, tiebreak)


def explore_counts(
    df: DataFrame, keys: Sequence[str] | None = None, time_range: str = "all", ts: str = "ts",
    limit: int = 500, session_start: datetime | None = None,
) -> DataFrame:
    """How many rows the table view shows, out of how many."""
    chosen = select_keys(trailing_range(df, time_range, ts, session_start), keys)
    total = F.count(F.lit(1))
    return chosen.agg(F.least(total, F.lit(limit)).alias("shown_rows"), total.alias("total_rows"))
