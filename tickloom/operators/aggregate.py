"""Tumbling windows, resampling and the per-key or global summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import INTERVALS, box_statistics, micros
from tickloom.operators.filters import last_n_per_key
from tickloom.operators.quantiles import BUFFER_ROWS, exact_quantiles
from tickloom.scale import KeyProfile, over_rows, profile, ordered
from tickloom.schemas import GOLD_SERIES, SERIES, SILVER_SERIES, Series

DEFAULT_STEP_MICROS = 60_000_000
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def gold_columns() -> list[Column]:
    """The gold aggregates over ticks; batch and streaming share them."""
    return [
        F.avg("price_usd").alias("avg_price"), F.min("price_usd").alias("min_price"),
        F.max("price_usd").alias("max_price"), F.avg("volume_24h_usd").alias("avg_volume"),
        F.avg("change_24h_pct").alias("avg_change_pct"),
        F.coalesce(F.stddev_samp("price_usd"), F.lit(0.0)).alias("price_volatility"),
        F.count("price_usd").alias("record_count"),
    ]


def to_gold(silver: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Epoch-aligned tumbling aggregate per key. Rows without a key or time are left out.

    A table without times is returned as it is.
    """
    if "fetched_at" not in silver.columns:
        return silver
    ticks = silver.where(F.col("coin_id").isNotNull())
    ticks = ticks.withColumn("_ts", F.col("fetched_at").cast("timestamp"))
    return flat_window(ticks.groupBy("coin_id", F.window("_ts", width).alias("_w")).agg(*gold_columns()))


def flat_window(windowed: DataFrame, key: str = "coin_id") -> DataFrame:
    rest = [c for c in windowed.columns if c not in (key, "_w")]
    return windowed.select(
        key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest
    )


def resample_columns(df: DataFrame, by: Series = GOLD_SERIES) -> list[Column]:
    """min_price takes the min, max_price the max, volume and counts the sum, the rest the mean."""
    chosen = []
    for field in df.schema.fields:
        name = field.name
        if not isinstance(field.dataType, T.NumericType) or name == by.key:
            continue
        if name == by.low:
            agg = F.min(name)
        elif name == by.high:
            agg = F.max(name)
        elif name in (by.volume, "record_count"):
            agg = F.coalesce(F.sum(name), F.lit(0))  # a sum over no values is 0
        else:
            agg = F.avg(name)
        chosen.append(agg.alias(name))
    return chosen


def resample(gold: DataFrame, interval: str, by: Series = GOLD_SERIES) -> DataFrame:
    """Coarser bins of a gold series. "1m" and unknown intervals return it unchanged.

    Only numeric columns survive, so ``window_end`` disappears; bins without an average are
    dropped.
    """
    if interval not in INTERVALS:
        return gold
    columns = resample_columns(gold, by)
    binned = gold.groupBy(by.key, F.window(by.ts, INTERVALS[interval]).alias("_w")).agg(*columns)
    binned = binned.select(by.key, F.col("_w.start").alias(by.ts), *[c for c in binned.columns if c not in (by.key, "_w")])
    averages = [c for c in binned.columns if c.startswith("avg_")]
    return binned.where(F.col(averages[0]).isNotNull()) if averages else binned


def volatility_series(df: DataFrame, layer: str = "gold") -> DataFrame:
    """Series behind the volatility chart: gold has the deviation; for silver it is the volume."""
    by, column = (GOLD_SERIES, "price_volatility") if layer == "gold" else (SILVER_SERIES, "volume_24h_usd")
    name = column if layer == "gold" else "volume"
    return df.select(by.key, by.ts, F.col(column).alias(name))


def latest_of(name: str, by: Series) -> Column:
    """Value of a column on the newest row: a partial aggregate, no sort of the key's rows."""
    order = F.col(by.ts) if not by.tiebreak else F.struct(*by.order)
    return F.max_by(name, order)


def earliest_of(name: str, by: Series) -> Column:
    order = F.col(by.ts) if not by.tiebreak else F.struct(*by.order)
    return F.min_by(name, order)


def latest_per_key(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """The newest row of every key."""
    if by.tiebreak:
        row = F.max_by(F.struct(*df.columns), F.struct(*by.order)).alias("_row")
        return df.groupBy(by.key).agg(row).select("_row.*").select(*df.columns)
    rest = [c for c in df.columns if c not in (by.key, by.ts)]
    newest = df.groupBy(by.key).agg(F.max(by.ts).alias(by.ts), *[latest_of(c, by).alias(c) for c in rest])
    return newest.select(*df.columns)


def status_by_key(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Rows, latest, mean, min, max and volume total of every key."""
    return df.groupBy(by.key).agg(
        F.count(F.lit(1)).alias("records"), latest_of(by.value, by).alias("latest"),
        F.avg(by.value).alias("avg"), F.min(by.value).alias("min"), F.max(by.value).alias("max"),
        F.coalesce(F.sum(by.volume), F.lit(0.0)).alias("volume"),
    )


def freshness(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def keys_union(*layers: DataFrame, key: str = "coin_id") -> DataFrame:
    """Distinct keys over all layers."""
    distinct = [layer.select(key).distinct() for layer in layers]
    out = distinct[0]
    for more in distinct[1:]:
        out = out.unionByName(more)
    return out.where(F.col(key).isNotNull()).distinct()


def layer_counts(gold: DataFrame, silver: DataFrame, key: str = "coin_id") -> DataFrame:
    """Exact row counts of both layers, number of keys, the layer the views use, and ``updated_at``,
    the newest event time of that layer.

    Scalar subqueries: each count runs on its own, nothing is joined.
    """
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def newest(df: DataFrame) -> Column:
        ts = next((c for c in ("window_start", "fetched_at", "ts") if c in df.columns), None)
        return df.agg(F.max(F.col(ts).cast("timestamp")).alias("t")).scalar() if ts else F.lit(None).cast("timestamp")

    one = gold.sparkSession.range(1)
    counted = one.select(
        rows(gold).alias("gold_rows"), rows(silver).alias("silver_rows"),
        rows(keys_union(gold, silver, key=key)).alias("keys"),
    )
    in_gold = F.col("gold_rows") > 0
    return counted.withColumn("layer", F.when(in_gold, "Gold").otherwise("Silver")).withColumn(
        "updated_at", F.when(in_gold, newest(gold)).otherwise(newest(silver)))


def volume_total(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Total volume of every key that has any."""
    total = df.groupBy(by.key).agg(F.sum(by.volume).alias("total_volume"))
    return total.where(F.col("total_volume").isNotNull())


def _box(grouped, value: str) -> DataFrame:
    """Box statistics of bounded groups in one aggregate."""
    q = F.percentile(value, list(QUARTILES.values())).alias("_q")
    out = grouped.agg(*box_statistics(value), q)
    return out.withColumns({name: F.col("_q")[i] for i, name in enumerate(QUARTILES)}).drop("_q")


def distribution(
    df: DataFrame, value: str, key: str = "coin_id", size: KeyProfile | None = None
) -> DataFrame:
    """Box statistics per key: n, mean, sd, min, max and interpolated quartiles."""
    size = size or profile(df, Series(key=key))
    rows = df.where(F.col(value).isNotNull())
    if not size.exceeds(BUFFER_ROWS):
        return _box(rows.groupBy(key), value)
    return rows.groupBy(key).agg(*box_statistics(value)).join(
        exact_quantiles(rows, value, QUARTILES, key, size), key
    )


def returns_distribution(returns: DataFrame, by: Series = SERIES, last: int = 50) -> DataFrame:
    """Box statistics over the newest ``last`` returns of every key (a bounded group)."""
    return _box(last_n_per_key(returns, last, by).groupBy(by.key), "return_pct")


def horizon(
    df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None, more: Sequence[Column] = ()
) -> DataFrame:
    """Per key: ``last_micros``, and ``step_micros``, the median step between its rows.

    A key with a single row counts as sampled once a minute. ``more`` are further aggregates of the
    same pass, over the key, order, value and volume columns.
    """
    size = size or profile(df, by)

    def step(rows: DataFrame, part: list[str]) -> DataFrame:
        return rows.withColumn("_step", F.col("_at") - F.lag("_at").over(ordered(part, by)))

    read = [by.value, by.volume] if more else []
    timed = df.select(by.key, *by.order, *read, micros(by.ts).alias("_at"))
    steps = over_rows(timed, step, 1, by, size)
    last = F.max("_at").alias("last_micros")
    if not size.exceeds(BUFFER_ROWS):
        ends = steps.groupBy(by.key).agg(last, F.percentile("_step", 0.5).alias("_median"), *more)
    else:
        medians = exact_quantiles(steps, "_step", {"_median": 0.5}, by.key, size)
        ends = timed.groupBy(by.key).agg(last, *more).join(medians, by.key, "left")
    known = F.floor("_median").cast("bigint")
    rest = [c for c in ends.columns if c not in (by.key, "last_micros", "_median")]
    return ends.select(
        by.key, "last_micros", F.coalesce(known, F.lit(DEFAULT_STEP_MICROS)).alias("step_micros"), *rest
    )


def sampling_interval(
    df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None
) -> DataFrame:
    """Median step between consecutive rows of a key in microseconds."""
    return horizon(df, by, size).select(by.key, "step_micros")
