"""Rule alerts: evaluation, rule table upkeep, history views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import shorten_number
from tickloom.operators.aggregate import latest_of
from tickloom.schemas import SERIES, Series


def latest_metrics(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """One row per key: the value and change of its newest row."""
    return df.groupBy(by.key).agg(
        latest_of(by.value, by).alias("_value"), latest_of(by.change, by).alias("_change")
    )


def check_alerts(
    df: DataFrame, rules: DataFrame, by: Series = SERIES, checked_at: datetime | None = None
) -> DataFrame:
    """Active rules that hold on the newest row of their key, as history entries.

    Comparisons are strict, unknown rule types never fire, and firing leaves a rule active.
    """
    active = rules.where(F.coalesce(F.col("active"), F.lit(False)))
    met = active.join(latest_metrics(df, by), F.col("coin") == F.col(by.key))
    seen = F.when(F.col("type") == "price", F.col("_value")).when(F.col("type") == "change_24h", F.col("_change"))
    fires = ((F.col("condition") == "above") & (seen > F.col("threshold"))) | (
        (F.col("condition") == "below") & (seen < F.col("threshold"))
    )
    at = F.lit(checked_at) if checked_at is not None else F.current_timestamp()
    return met.where(fires).select(
        "id", F.date_format(at, "HH:mm:ss").alias("time"), F.upper("coin").alias("coin"), "type",
        F.concat_ws(" ", F.upper("coin"), "condition", shorten_number("threshold")).alias("message"),
    )


def suggested_threshold(keys: DataFrame, df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Default thresholds of a new rule: 110 % of the latest value for price, 5 for change."""
    latest = df.groupBy(by.key).agg(latest_of(by.value, by).alias("_value"))
    price = F.round(F.coalesce(F.col("_value"), F.lit(0.0)) * 1.1, 2)
    return keys.select(by.key).distinct().join(latest, by.key, "left").select(
        by.key, price.alias("price_threshold"), F.lit(5.0).alias("change_threshold")
    )


def add_rule(
    rules: DataFrame, coin: str, kind: str, condition: str, threshold: float | None,
    created_at: datetime | None = None,
) -> DataFrame:
    """The rule table plus one active rule; without a coin or condition it is unchanged."""
    if not coin or not condition:
        return rules
    at = F.lit(created_at) if created_at is not None else F.current_timestamp()
    new = rules.sparkSession.range(1).select(
        F.unix_millis(at).alias("id"), F.lit(coin).alias("coin"), F.lit(kind).alias("type"),
        F.lit(condition).alias("condition"), F.lit(float(threshold or 0)).alias("threshold"),
        F.lit(True).alias("active"),
    )
    return rules.unionByName(new)


def remove_rules(rules: DataFrame, ids: DataFrame) -> DataFrame:
    """Rules whose id is not listed."""
    return rules.join(ids.select("id"), "id", "left_anti").select(*rules.columns)


def recent_history(history: DataFrame, seq: str, n: int = 50) -> DataFrame:
    """The last ``n`` entries, newest first."""
    return history.orderBy(F.col(seq).desc()).limit(n)
