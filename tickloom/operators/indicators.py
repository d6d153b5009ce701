"""Row-window indicators: moving averages, bands, RSI, candles.

All indicators of a call share one partitioning and one sort; see ``scale.over_rows`` for
what happens with very long keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import direction
from tickloom.operators.filters import min_history
from tickloom.scale import KeyProfile, last_rows, ordered, over_rows, profile
from tickloom.schemas import SERIES, Series

RSI_PERIOD = 14
BAND_WINDOW, BAND_WIDTH = 20, 2.0
PANEL_MIN_ROWS = 5


def measure(
    rows: DataFrame, part: list[str], by: Series, windows: Sequence[int] = (), band: int | None = None,
    width: float = BAND_WIDTH, previous: bool = False,
) -> DataFrame:
    """``sma_<w>`` per window, the three band columns, ``_previous``: one window operator.

    An average is null until its whole window holds values.
    """
    value, full, measured = F.col(by.value), {}, {}
    if previous:
        measured["_previous"] = F.lag(by.value).over(ordered(part, by))
    for w in dict.fromkeys([*windows, *([band] if band else [])]):
        frame = last_rows(part, by, w)
        measured.update({f"_n{w}": F.count(value).over(frame), f"_avg{w}": F.avg(value).over(frame)})
        full[f"_avg{w}"] = F.when(F.col(f"_n{w}") == w, F.col(f"_avg{w}"))
    if band:
        measured["_sd"] = F.stddev_samp(value).over(last_rows(part, by, band))
        full["_sd"] = F.when(F.col(f"_n{band}") == band, F.col("_sd") * width)
    named = {f"sma_{w}": F.col(f"_avg{w}") for w in windows}
    if band:
        middle, spread = F.col(f"_avg{band}"), F.col("_sd")
        named.update({"bb_middle": middle, "bb_upper": middle + spread, "bb_lower": middle - spread})
    helpers = [name for name in measured if name != "_previous"]
    return rows.withColumns(measured).withColumns(full).withColumns(named).drop(*helpers)


def rsi_column(delta: str, period: int, part: list[str], by: Series, on_zero_loss: str = "null") -> Column:
    """Relative strength from simple rolling means of gains and losses.

    ``on_zero_loss``: "null" leaves windows without a loss null; "bound" gives 100 if there
    was a gain and 50 for a flat window.
    """
    frame = last_rows(part, by, period)
    step = F.col(delta)
    # when(), not greatest(): the missing first step must stay null
    gain = F.avg(F.when(step > 0, step).when(step <= 0, 0.0)).over(frame)
    loss = F.avg(F.when(step < 0, -step).when(step >= 0, 0.0)).over(frame)
    strength = F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + F.try_divide(gain, loss))
    if on_zero_loss == "bound":
        strength = F.when(loss == 0, F.when(gain > 0, 100.0).otherwise(50.0)).otherwise(strength)
    return F.when(F.count(step).over(frame) == period, strength)


def _add_rsi(rows, part, by, period=RSI_PERIOD, on_zero_loss="null"):
    """RSI from ``_previous``."""
    stepped = rows.withColumn("_step", F.col(by.value) - F.col("_previous"))
    strength = rsi_column("_step", period, part, by, on_zero_loss)
    return stepped.withColumn(f"rsi_{period}", strength).drop("_step")


def _add_candles(rows, by):
    """Candle columns from ``_previous``."""
    opened = F.coalesce(F.col("_previous"), F.col(by.value))
    with_open = rows.withColumns({"open": opened, "close": F.col(by.value)})
    high = F.col(by.high) if by.high in rows.columns else F.col(by.value)
    low = F.col(by.low) if by.low in rows.columns else F.col(by.value)
    # greatest and least skip nulls, so a missing high or low falls back to open and close
    return with_open.withColumns({
        "candle_high": F.greatest(high, "open", "close"), "candle_low": F.least(low, "open", "close"),
    })


def sma(df: DataFrame, windows: int | Sequence[int] = (10, 20), by: Series = SERIES, size: KeyProfile | None = None) -> DataFrame:
    """``sma_<w>`` for each window."""
    chosen = [windows] if isinstance(windows, int) else list(windows)
    return over_rows(df, lambda rows, part: measure(rows, part, by, chosen), max(chosen) - 1, by, size)


def bollinger(
    df: DataFrame, window: int = BAND_WINDOW, num_std: float = BAND_WIDTH, by: Series = SERIES,
    size: KeyProfile | None = None,
) -> DataFrame:
    """``bb_middle``, ``bb_upper``, ``bb_lower``: moving average and ± num_std deviations."""
    def bands(rows: DataFrame, part: list[str]) -> DataFrame:
        return measure(rows, part, by, band=window, width=num_std)

    return over_rows(df, bands, window - 1, by, size)


def rsi(
    df: DataFrame, period: int = RSI_PERIOD, by: Series = SERIES, on_zero_loss: str = "null",
    size: KeyProfile | None = None,
) -> DataFrame:
    """``rsi_<period>``; the first value needs period + 1 rows."""
    def strength(rows: DataFrame, part: list[str]) -> DataFrame:
        return _add_rsi(measure(rows, part, by, previous=True), part, by, period, on_zero_loss).drop("_previous")

    return over_rows(df, strength, period, by, size)


def ohlc(df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None) -> DataFrame:
    """``open`` (the value before), ``close``, ``candle_high``, ``candle_low``."""
    def candles(rows: DataFrame, part: list[str]) -> DataFrame:
        return _add_candles(measure(rows, part, by, previous=True), by).drop("_previous")

    return over_rows(df, candles, 1, by, size)


def all_indicators(rows: DataFrame, part: list[str], by: Series) -> DataFrame:
    """Every panel indicator over rows that are already partitioned by ``part``."""
    out = _add_candles(measure(rows, part, by, (10, 20), BAND_WINDOW, previous=True), by)
    return _add_rsi(out, part, by).drop("_previous")


ALL_HALO = max(BAND_WINDOW - 1, RSI_PERIOD)


def indicators(df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None) -> DataFrame:
    """Candles, SMA 10 and 20, bands and RSI in one pass."""
    return over_rows(df, lambda rows, part: all_indicators(rows, part, by), ALL_HALO, by, size)


def technical_panel(
    df: DataFrame, by: Series = SERIES, key: str | None = None, size: KeyProfile | None = None
) -> DataFrame:
    """Panel rows of one key, or of all keys: indicators plus the volume bar's direction.

    ``df`` is already cut to the range and resampled, in this order, by the caller. Keys
    with fewer than five rows have no panel.
    """
    rows = df if key is None else df.where(F.col(by.key) == key)
    size = size or profile(rows, by)
    enough = min_history(rows, PANEL_MIN_ROWS, by, size)
    return indicators(enough, by, size).withColumn("volume_direction", direction(by.change, null_as="up"))
