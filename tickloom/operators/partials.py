"""Gold windows that merge: what a window keeps so that later ticks can be added to it.

A window's partial row holds counts, sums, extremes and the sum of squared deviations of its prices.
Two partial rows of a window give the row of both; deviations merge pairwise, without the cancellation
that sums of squares have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.aggregate import flat_window
from tickloom.schemas import GOLD
from tickloom.sources.versions import BATCH

WINDOW = ("coin_id", "window_start", "window_end")
PARTIAL = T.StructType([
    *(f for f in GOLD.fields if f.name in WINDOW), T.StructField("n", T.LongType(), True),
    *(T.StructField(c, T.DoubleType(), True) for c in ("mean", "m2", "low", "high")),
    T.StructField("volume_n", T.LongType(), True), T.StructField("volume_sum", T.DoubleType(), True),
    T.StructField("change_n", T.LongType(), True), T.StructField("change_sum", T.DoubleType(), True),
])


def gold_partials(ticks: DataFrame, width: str = "10 seconds") -> DataFrame:
    """One partial row for each key and window; ticks without a key or time are left out."""
    price = F.col("price_usd")
    timed = ticks.where(F.col("coin_id").isNotNull()).withColumn("_ts", F.col("fetched_at").cast("timestamp"))
    return flat_window(timed.groupBy("coin_id", F.window("_ts", width).alias("_w")).agg(
        F.count(price).alias("n"), F.coalesce(F.avg(price), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(price) * F.count(price), F.lit(0.0)).alias("m2"),
        F.min(price).alias("low"), F.max(price).alias("high"),
        F.count("volume_24h_usd").alias("volume_n"), F.sum("volume_24h_usd").alias("volume_sum"),
        F.count("change_24h_pct").alias("change_n"), F.sum("change_24h_pct").alias("change_sum"),
    ))


def both(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two sets of prices together."""
    n = a["n"] + b["n"]
    step = b["mean"] - a["mean"]
    share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
    return F.struct(
        n.alias("n"), (a["mean"] + step * share).alias("mean"), (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2")
    )


def merge_partials(rows: DataFrame) -> DataFrame:
    """One row for each window of any partial rows. A window has few: one for each stored folder."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    merged = rows.groupBy(*WINDOW).agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("n", "mean", "m2"))), none, both).alias("_prices"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        *(F.sum(c).alias(c) for c in ("volume_n", "volume_sum", "change_n", "change_sum")),
        F.max(BATCH).alias(BATCH),
    )
    return merged.select(*WINDOW, "_prices.*", "low", "high", "volume_n", "volume_sum", "change_n", "change_sum", BATCH)


def gold_of(partials: DataFrame) -> DataFrame:
    """The gold columns of merged partial rows."""
    spread = F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))
    some = F.col("n") > 0
    return partials.select(
        *WINDOW, F.when(some, F.col("mean")).alias("avg_price"), F.col("low").alias("min_price"), F.col("high").alias("max_price"),
        F.try_divide("volume_sum", "volume_n").alias("avg_volume"), F.try_divide("change_sum", "change_n").alias("avg_change_pct"),
        F.when(F.col("n") > 1, spread).otherwise(0.0).alias("price_volatility"), F.col("n").alias("record_count"),
    )
