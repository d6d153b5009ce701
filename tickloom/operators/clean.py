"""Type normalisation, cleaning, quality flags, de-duplication and series preparation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.columns import moment, number, quality_flag
from tickloom.schemas import (
    GOLD_SERIES, NUMERIC_TICK_COLUMNS, RAW_TEXT, SILVER_SERIES, Series,
)


def normalize_types(raw: DataFrame) -> DataFrame:
    """Typed ticks: missing columns become null, bad numbers and times become null.

    Extra columns pass through. ``last_updated`` holds epoch seconds unless it is a timestamp.
    """
    present = dict(raw.dtypes)
    typed = {}
    for name in RAW_TEXT.fieldNames():
        source = F.col(name) if name in present else F.lit(None).cast("string")
        if name in NUMERIC_TICK_COLUMNS:
            typed[name] = number(source)
        elif name == "fetched_at" or present.get(name, "").startswith("timestamp"):
            typed[name] = moment(source)
        elif name == "last_updated":
            typed[name] = F.timestamp_seconds(number(source))
        else:
            typed[name] = source.cast("string")
    return raw.withColumns(typed)


def drop_unusable(ticks: DataFrame) -> DataFrame:
    """Keep rows with a key and a positive price."""
    price = F.col("price_usd")
    return ticks.where(F.col("coin_id").isNotNull() & ~F.isnan(price) & (price > 0))


def flag_quality(ticks: DataFrame) -> DataFrame:
    """``data_quality_flag`` from the 24h change; without that column every row is good."""
    if "change_24h_pct" not in ticks.columns:
        return ticks.withColumn("data_quality_flag", F.lit("good"))
    return ticks.withColumn("data_quality_flag", quality_flag("change_24h_pct"))


def dedup_first(df: DataFrame, keys: Iterable[str], arrival: Iterable[str]) -> DataFrame:
    """The first row to arrive of each key combination; null keys count as equal.

    The rank filter is applied map-side first, so at most one copy per input partition is
    shuffled, however many copies there are.
    """
    first = Window.partitionBy(*keys).orderBy(*arrival)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def to_silver(ticks: DataFrame, arrival: Iterable[str]) -> DataFrame:
    """Normalised ticks -> cleaned, flagged and de-duplicated ticks."""
    flagged = flag_quality(drop_unusable(ticks))
    keys = [c for c in ("coin_id", "fetched_at") if c in flagged.columns]
    return dedup_first(flagged, keys, arrival)


def unknown_keys(requested: DataFrame, known: DataFrame, key: str = "coin_id") -> DataFrame:
    """Requested ids (trimmed) that are not in the known set; reported, not rejected."""
    asked = requested.select(F.trim(F.col(key)).alias(key)).where(F.col(key) != "").distinct()
    return asked.join(known.select(key), key, "left_anti")


def split_keys(lists: DataFrame, column: str, key: str = "coin_id") -> DataFrame:
    """Comma-separated id lists to one id per row."""
    return lists.select(F.explode(F.split(column, ",")).alias(key))


def prepare_series(
    df: DataFrame, time_col: str, value_col: str, extra_cols: Iterable[str] = ()
) -> DataFrame:
    """Coerce time and numbers, drop rows without a time or value. Sorting is left to the sink."""
    numeric = [value_col, *(c for c in extra_cols if c in df.columns)]
    typed = df.withColumns({time_col: moment(time_col), **{c: number(c) for c in numeric}})
    return typed.where(F.col(value_col).isNotNull() & F.col(time_col).isNotNull())


def canonical_series(
    gold: DataFrame | None = None, silver: DataFrame | None = None, layer: str | None = None
) -> DataFrame:
    """(coin_id, ts, value, volume, change, high, low) from gold if it has rows, else silver.

    Naming the ``layer`` avoids the look at the data.
    """
    if layer is None:
        has_gold = gold is not None and not gold.isEmpty()
        layer = "gold" if has_gold or silver is None else "silver"
    df, role = (gold, GOLD_SERIES) if layer == "gold" else (silver, SILVER_SERIES)
    prepared = prepare_series(df, role.ts, role.value, {role.volume, role.change, role.high, role.low})
    return as_series(prepared, role)


def as_series(df: DataFrame, role: Series) -> DataFrame:
    """Rename the columns of one layer to the canonical roles."""
    def pick(name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    return df.select(
        F.col(role.key).alias("coin_id"), F.col(role.ts).cast("timestamp").alias("ts"),
        F.col(role.value).alias("value"), pick(role.volume).alias("volume"),
        pick(role.change).alias("change"), pick(role.high).alias("high"),
        pick(role.low).alias("low"), *role.tiebreak,
    )
