"""The analytics views, each a composition of operators over the layer tables.

The order of steps matters and differs by view: the overview resamples, then cuts the range;
the technical view cuts the range, then resamples (its first bin may be partial); comparison
and forecasts use the whole resampled series; explorer and status use gold as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import direction
from tickloom.operators import aggregate, compare, filters, forecast, indicators, signals
from tickloom.scale import KeyProfile, profile
from tickloom.schemas import GOLD_SERIES, Series


def overview(
    gold: DataFrame, keys: Sequence[str], interval: str = "1m", time_range: str = "all",
    tz_offset: int = 0, by: Series = GOLD_SERIES, session_start: datetime | None = None,
) -> DataFrame:
    """Value, volume and change series of the chosen keys, with the change direction."""
    ranged = filters.trailing_range(
        aggregate.resample(gold, interval, by), time_range, by.ts, session_start, tz_offset
    )
    chosen = filters.select_keys(ranged, keys, by.key, empty_means="none")
    return chosen.withColumn("direction", direction(by.change))


def technical(
    gold: DataFrame, key: str | None = None, interval: str = "1m", time_range: str | None = None,
    by: Series = GOLD_SERIES, size: KeyProfile | None = None, session_start: datetime | None = None,
) -> DataFrame:
    """Panel rows of one key (or all). ``size`` may be the profile of ``gold``: a safe bound."""
    ranged = filters.trailing_range(gold, time_range, by.ts, session_start)
    binned = aggregate.resample(ranged, interval, by)
    return indicators.technical_panel(binned, by, key, size)


def technical_cards(
    gold: DataFrame, interval: str = "1m", time_range: str | None = None, by: Series = GOLD_SERIES,
) -> DataFrame:
    """Summary and signals of the last row of each key."""
    binned = aggregate.resample(filters.trailing_range(gold, time_range, by.ts), interval, by)
    return signals.technical_cards(binned, by)


def comparison(
    gold: DataFrame, keys: Sequence[str], interval: str = "1m", by: Series = GOLD_SERIES,
) -> dict[str, DataFrame]:
    """Normalised series, correlation, volume totals and returns of two keys or more."""
    rows = filters.select_keys(aggregate.resample(gold, interval, by), keys, by.key)
    size = profile(rows, by)
    return {
        "normalized": compare.normalized(rows, by, size),
        "correlation": compare.correlation_matrix(rows, None, by, size=size),
        "volume": aggregate.volume_total(rows, by),
        "returns": aggregate.returns_distribution(compare.returns(rows, by, size), by),
    }


def predictions(
    gold: DataFrame, keys: Sequence[str] | None = None, interval: str = "1m", model: str = "ar",
    steps: int = forecast.STEPS, by: Series = GOLD_SERIES,
) -> dict[str, DataFrame]:
    """Forecast rows, their summary, and history plus forecast."""
    rows = filters.select_keys(aggregate.resample(gold, interval, by), keys, by.key)
    ahead = forecast.forecast(rows, model, steps, by)
    return {
        "forecast": ahead,
        "summary": forecast.forecast_summary(ahead, rows, by),
        "series": forecast.actual_plus_forecast(ahead, rows, by),
    }


def status(gold: DataFrame, silver: DataFrame, by: Series = GOLD_SERIES) -> dict[str, DataFrame]:
    """Per-key status, freshness and layer counts."""
    return {
        "keys": aggregate.status_by_key(gold, by).orderBy(F.col("records").desc(), by.key),
        "freshness": aggregate.freshness(gold, by.ts),
        "layers": aggregate.layer_counts(gold, silver, by.key),
    }
