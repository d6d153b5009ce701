"""How series with few, very long keys are spread over a cluster.

A row window partitioned by key is one task per key. That is right while every key fits a
task, and wrong when one key holds a third of all rows. ``profile`` measures the keys with
one aggregated pass over the key column; the helpers here then pick the plan:

* no key above ``block rows``: the plain window over the key;
* otherwise the key's time axis is cut into blocks (30 days, a day, an hour, a minute: only
  as fine as its rows require), the last ``halo`` rows before each block are copied into it,
  and the window runs over (key, block). Row frames reach back a fixed number of rows, so
  the result is exactly the one of the plain window.

Small tables that are broadcast have a proven bound: a key or bucket is "hot" only when it
holds more than ``block rows`` rows, and block rows is at least rows / MAX_SMALL_ROWS, so
there are at most MAX_SMALL_ROWS of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tickloom.schemas import SERIES, Series
from tickloom.session import materialize

DEFAULT_BLOCK_ROWS = 1_000_000
BLOCK_ROWS_SETTING = "tickloom.block.rows"
MAX_SMALL_ROWS = 100_000
# Nested bucket widths in seconds, coarse to fine; each divides the one before it.
WIDTHS = (2_592_000, 86_400, 3_600, 60)
BLOCK, HALO = "_block", "_halo"


@dataclass
class KeyProfile:
    """Size of a keyed table. The profile of a table is a safe bound for its subsets."""

    keys: int
    rows: int
    max_rows: int
    block_rows: int
    source: DataFrame | None = None
    by: Series = SERIES
    _hot: tuple[DataFrame, DataFrame] | None = None

    @property
    def hot(self) -> bool:
        return self.max_rows > self.block_rows

    def exceeds(self, rows: int) -> bool:
        """Whether a key is too long for a step that holds ``rows`` rows of it in memory."""
        return self.max_rows > min(rows, self.block_rows)

    @property
    def few_keys(self) -> bool:
        return self.keys <= MAX_SMALL_ROWS

    def hot_buckets(self) -> tuple[DataFrame, DataFrame]:
        """Keys, and (key, width, start) buckets, above the block size; computed once."""
        if self._hot is None:
            self._hot = _hot_buckets(self.source, self.by, self.block_rows)
        return self._hot


def profile(df: DataFrame, by: Series = SERIES, block_rows: int | None = None) -> KeyProfile:
    """Number of keys, rows, and rows of the largest key: one pass, partially aggregated."""
    size = (
        df.groupBy(by.key).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count("n").alias("keys"), F.sum("n").alias("rows"), F.max("n").alias("top"))
        .first()
    )
    keys, rows, top = size["keys"], size["rows"] or 0, size["top"] or 0
    limit = block_rows or int(df.sparkSession.conf.get(BLOCK_ROWS_SETTING, str(DEFAULT_BLOCK_ROWS)))
    return KeyProfile(keys, rows, top, max(limit, -(-rows // MAX_SMALL_ROWS)), df, by)


def ordered(part: list[str], by: Series, newest_first: bool = False) -> WindowSpec:
    order = [F.col(c).desc() if newest_first else F.col(c).asc() for c in by.order]
    return Window.partitionBy(*part).orderBy(*order)


def last_rows(part: list[str], by: Series, n: int) -> WindowSpec:
    """The current row and the n - 1 rows before it."""
    return ordered(part, by).rowsBetween(-(n - 1), Window.currentRow)


def join_stats(df: DataFrame, stats: DataFrame, key: str, size: KeyProfile, how: str = "inner") -> DataFrame:
    """Attach one-row-per-key statistics to the rows of their key.

    Few keys (checked): broadcast, the rows do not move. Many keys: a shuffle join, in which
    AQE splits the partition of a hot key.
    """
    return df.join(F.broadcast(stats) if size.few_keys else stats, key, how)


def _bucket(seconds: Column, width: int) -> Column:
    return seconds - F.pmod(seconds, F.lit(width))


def _hot_buckets(df: DataFrame, by: Series, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Keys, and (key, width, start) time buckets, that hold more than block_rows rows."""
    limit = F.lit(block_rows)
    keys = materialize(
        df.groupBy(by.key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(by.key)
    )
    minutes = (
        df.join(F.broadcast(keys), by.key, "left_semi")
        .groupBy(by.key, _bucket(F.unix_seconds(F.col(by.ts).cast("timestamp")), WIDTHS[-1]).alias("_minute"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    crowded = [
        minutes.groupBy(by.key, _bucket(F.col("_minute"), width).alias("_start"))
        .agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit)
        .select(by.key, F.lit(width).alias("_width"), "_start")
        for width in WIDTHS[:-1]
    ]
    return keys, materialize(reduce(DataFrame.unionAll, crowded))


def assign_blocks(df: DataFrame, by: Series, size: KeyProfile) -> DataFrame:
    """Add ``_block`` (start of the row's block, rising with time) and ``_hot_key``.

    The finest block is a minute. With unique microsecond times a minute of one key is
    bounded, whatever the total is.
    """
    keys, crowded = size.hot_buckets()
    second = F.unix_seconds(F.col(by.ts).cast("timestamp"))
    out = df.join(F.broadcast(keys.withColumn("_hot_key", F.lit(True))), by.key, "left")
    block = F.when(F.col("_hot_key").isNull(), F.lit(0).cast("bigint"))
    helpers = []
    for width in WIDTHS[:-1]:
        start, mark = f"_start_{width}", f"_crowded_{width}"
        marks = crowded.where(F.col("_width") == width).select(
            by.key, F.col("_start").alias(start), F.lit(True).alias(mark)
        )
        out = out.withColumn(start, _bucket(second, width)).join(F.broadcast(marks), [by.key, start], "left")
        block = block.when(F.col(mark).isNull(), F.col(start))
        helpers += [start, mark]
    out = out.withColumn(BLOCK, block.otherwise(_bucket(second, WIDTHS[-1])))
    return out.withColumn("_hot_key", F.coalesce("_hot_key", F.lit(False))).drop(*helpers)


def _with_halo(blocked: DataFrame, by: Series, halo: int) -> DataFrame:
    """Copy the ``halo`` rows that precede each block into it, marked ``_halo``.

    Only the last ``halo`` rows of a block can precede another block that closely. Among
    these tails, a row belongs to the halo of every later block that starts within the next
    ``halo`` tail rows, which also covers blocks shorter than the halo.
    """
    tails = (
        blocked.where("_hot_key")
        .withColumn("_r", F.row_number().over(ordered([by.key, BLOCK], by, newest_first=True)))
        .where(F.col("_r") <= halo).drop("_r")
    )
    ahead = ordered([by.key], by).rowsBetween(1, halo)
    copies = (
        tails.withColumn("_next", F.array_distinct(F.collect_list(BLOCK).over(ahead)))
        .withColumn("_next", F.array_remove("_next", F.col(BLOCK)))
        .withColumn(BLOCK, F.explode("_next")).drop("_next")
        .withColumn(HALO, F.lit(True))
    )
    return blocked.withColumn(HALO, F.lit(False)).unionByName(copies)


def over_rows(
    df: DataFrame,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    halo: int,
    by: Series = SERIES,
    size: KeyProfile | None = None,
) -> DataFrame:
    """Run ``compute(rows, partition columns)`` with row windows that look back ``halo`` rows."""
    size = size or profile(df, by)
    if not size.hot:
        return compute(df, [by.key])
    framed = compute(_with_halo(assign_blocks(df, by, size), by, halo), [by.key, BLOCK])
    return framed.where(~F.col(HALO)).drop(BLOCK, HALO, "_hot_key")


def with_ordinal(
    df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None, name: str = "ordinal"
) -> DataFrame:
    """0-based position of each row within its key, in time order."""
    size = size or profile(df, by)
    if not size.hot:
        position = F.row_number().over(ordered([by.key], by)).cast("bigint") - 1
        return df.withColumn(name, position)
    blocked = assign_blocks(df, by, size)
    before = Window.partitionBy(by.key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(by.key, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
        .select(by.key, BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(ordered([by.key, BLOCK], by)).cast("bigint") - 1
    return (
        blocked.join(offsets, [by.key, BLOCK])
        .withColumn(name, F.col("_before") + inside)
        .drop(BLOCK, "_before", "_hot_key")
    )
