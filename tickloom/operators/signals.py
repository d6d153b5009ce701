"""Last-row summaries and trading signals.

Only the newest 20 rows of a key can influence its last-row indicators, so the operators cut
to those first (map-side ranked) and never move the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import percent_change
from tickloom.operators.aggregate import earliest_of, latest_of
from tickloom.operators.filters import last_n_per_key
from tickloom.operators.indicators import BAND_WINDOW, PANEL_MIN_ROWS, RSI_PERIOD, all_indicators
from tickloom.scale import ordered
from tickloom.schemas import SERIES, Series

# Texts of the signal explanations, with the numbers they quote.
RSI_TEXT = {
    "Bearish (Overbought)": "RSI is at %s, indicating the asset is overbought. A price correction or consolidation may occur.",
    "Bullish (Oversold)": "RSI is at %s, indicating the asset is oversold. A price bounce or trend reversal may be near.",
    "Neutral": "RSI is at %s, indicating standard momentum without overbought or oversold conditions.",
}
BAND_TEXT = {
    "Bearish (Overextended)": "Price ($%s) is trading near or above the upper Bollinger Band ($%s), indicating overextended territory.",
    "Bullish (Undervalued)": "Price ($%s) is trading near or below the lower Bollinger Band ($%s), indicating support/undervalued conditions.",
    "Neutral": "Price ($%s) is stable within the bands, trading near the middle line ($%s).",
    "Neutral (No Data)": "Insufficient data points to calculate Bollinger Bands.",
}
AVERAGE_TEXT = {
    "Bullish (Uptrend)": "Price ($%s) is above SMA(10) ($%s) and SMA(20) ($%s) in an uptrend, signaling upward momentum.",
    "Bearish (Downtrend)": "Price ($%s) is below SMA(10) ($%s) and SMA(20) ($%s) in a downtrend, signaling downward momentum.",
    "Neutral": "Price is trading between moving averages. SMA(10) is at $%s and SMA(20) is at $%s.",
    "Neutral (No Data)": "Insufficient data points to calculate moving averages.",
}
# The composite recommendation by score.
RECOMMENDATIONS = {2: "Strong Buy", 1: "Buy", 0: "Neutral", -1: "Sell", -2: "Strong Sell"}


def last_row_indicators(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """One row per key: row count, first and last value, and the indicators on the last row."""
    kept = [c for c in dict.fromkeys([by.key, *by.order, by.value, by.high, by.low]) if c in df.columns]
    newest = last_n_per_key(df.select(*kept), BAND_WINDOW, by)
    marked = all_indicators(newest, [by.key], by).withColumn(
        "_back", F.row_number().over(ordered([by.key], by, newest_first=True))
    )
    last = marked.where("_back = 1").select(
        by.key, F.col(by.ts).alias("last_ts"), F.col(by.value).alias("last_value"),
        "sma_10", "sma_20", "bb_middle", "bb_upper", "bb_lower", F.col(f"rsi_{RSI_PERIOD}").alias("_rsi"),
    )
    whole = df.groupBy(by.key).agg(
        F.count(F.lit(1)).alias("rows"), earliest_of(by.value, by).alias("first_value")
    )
    joined = last.join(whole, by.key)
    return joined.withColumn(
        "rsi", F.when(F.col("rows") < RSI_PERIOD, F.lit(50.0)).otherwise(F.col("_rsi"))
    ).drop("_rsi")


def rsi_zone(rsi: str = "rsi") -> Column:
    """Card label; a null falls to Oversold, as every failed comparison does."""
    r = F.col(rsi)
    return F.when((r > 30) & (r < 70), "Neutral").when(r >= 70, "Overbought").otherwise("Oversold")


def _card_columns() -> dict[str, Column]:
    """Summary of the last row, from ``last_row_indicators``."""
    width = F.when(F.col("rows") >= BAND_WINDOW, F.col("bb_upper") - F.col("bb_lower")).otherwise(0.0)
    return {
        "rsi_zone": rsi_zone(), "bb_width": width,
        "period_change_pct": percent_change("last_value", "first_value"),
    }


def technical_summary(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Current value, RSI and its zone, band width, and change over the whole period."""
    last = last_row_indicators(df, by).where(F.col("rows") >= PANEL_MIN_ROWS)
    cards = last.withColumns(_card_columns())
    return cards.select(
        by.key, F.col("last_value").alias("current"), "rsi", "rsi_zone", "bb_width", "period_change_pct"
    )


def technical_cards(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Summary and signals of each key together."""
    return signals(df, by).withColumns(_card_columns())


def _score(signal: str) -> Column:
    s = F.col(signal)
    return F.when(s.startswith("Bullish"), 1).when(s.startswith("Bearish"), -1).otherwise(0)


def signals(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """RSI, band and moving-average signals of the last row, their scores and the composite."""
    last = last_row_indicators(df, by).where(F.col("rows") >= PANEL_MIN_ROWS)
    price, rsi = F.col("last_value"), F.col("rsi")
    fast, slow, enough = F.col("sma_10"), F.col("sma_20"), F.col("rows") >= BAND_WINDOW
    by_rsi = (
        F.when(rsi >= 70, "Bearish (Overbought)").when(rsi <= 30, "Bullish (Oversold)").otherwise("Neutral")
    )
    by_band = (  # on narrow bands both tests hold; the upper one decides
        F.when(~enough, "Neutral (No Data)")
        .when(price >= F.col("bb_upper") * 0.98, "Bearish (Overextended)")
        .when(price <= F.col("bb_lower") * 1.02, "Bullish (Undervalued)").otherwise("Neutral")
    )
    by_average = (
        F.when(~enough, "Neutral (No Data)")
        .when((price > fast) & (fast > slow), "Bullish (Uptrend)")
        .when((price < fast) & (fast < slow), "Bearish (Downtrend)").otherwise("Neutral")
    )
    named = last.withColumns({"rsi_signal": by_rsi, "bb_signal": by_band, "ma_signal": by_average})
    scored = named.withColumns({
        "rsi_score": _score("rsi_signal"), "bb_score": _score("bb_signal"), "ma_score": _score("ma_signal"),
    })
    total = F.col("rsi_score") + F.col("bb_score") + F.col("ma_score")
    bounded = F.greatest(F.least(F.col("total_score"), F.lit(2)), F.lit(-2))
    verdict = F.lit(None).cast("string")
    for score, name in RECOMMENDATIONS.items():
        verdict = F.when(bounded == score, name).otherwise(verdict)
    return scored.withColumn("total_score", total).withColumn("recommendation", verdict)


def _fixed(c: str, digits: int) -> Column:
    # a decimal pattern rounds the binary value, format_string would round its shortest decimal text
    text = F.call_function("format_number", F.col(c), F.lit("0." + "0" * digits))
    return F.coalesce(text, F.lit("nan"))


def _explain(signal: str, texts: dict[str, str], *numbers: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, text in texts.items():
        wanted = numbers[len(numbers) - text.count("%s"):] if name == "Neutral" else numbers[: text.count("%s")]
        filled = F.format_string(text, *wanted) if wanted else F.lit(text)
        out = F.when(F.col(signal) == name, filled).otherwise(out)
    return out


def signal_text(signalled: DataFrame, by: Series = SERIES) -> DataFrame:
    """Explanations of the three signals with their numbers."""
    price, upper, lower, middle = (_fixed(c, 4) for c in ("last_value", "bb_upper", "bb_lower", "bb_middle"))
    edge = F.when(F.col("bb_signal") == "Bearish (Overextended)", upper).when(
        F.col("bb_signal") == "Bullish (Undervalued)", lower
    ).otherwise(middle)
    return signalled.select(
        by.key,
        _explain("rsi_signal", RSI_TEXT, _fixed("rsi", 1)).alias("rsi_text"),
        _explain("bb_signal", BAND_TEXT, price, edge).alias("bb_text"),
        _explain("ma_signal", AVERAGE_TEXT, price, _fixed("sma_10", 4), _fixed("sma_20", 4)).alias("ma_text"),
        "recommendation",
    )


def kpi_latest(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Last and previous value and the change between them, for keys with at least two rows."""
    rank = F.row_number().over(ordered([by.key], by, newest_first=True))
    two = df.select(by.key, *by.order, by.value).withColumn("_rank", rank).where("_rank <= 2")
    pair = two.groupBy(by.key).agg(
        F.max(F.when(F.col("_rank") == 1, F.col(by.value))).alias("last_value"),
        F.max(F.when(F.col("_rank") == 2, F.col(by.value))).alias("previous_value"),
        F.count(F.lit(1)).alias("_n"),
    ).where("_n = 2").drop("_n")
    change = F.coalesce(percent_change("last_value", "previous_value"), F.lit(0.0))
    return pair.withColumn("change_pct", change)


def period_change(df: DataFrame, by: Series = SERIES) -> DataFrame:
    """Change from the first to the last value of each key in percent; 0 for a single row."""
    ends = df.groupBy(by.key).agg(
        earliest_of(by.value, by).alias("first_value"), latest_of(by.value, by).alias("last_value"),
        F.count(F.lit(1)).alias("_n"),
    )
    change = F.when(F.col("_n") > 1, percent_change("last_value", "first_value")).otherwise(0.0)
    return ends.withColumn("change_pct", change).drop("_n")
