"""Analytics over keyed time series such as market ticks, as Spark DataFrame operators."""

from tickloom.operators.aggregate import (
    distribution, freshness, keys_union, latest_per_key, layer_counts, resample, returns_distribution,
    sampling_interval, status_by_key, to_gold, volatility_series, volume_total,
)
from tickloom.operators.alerts import add_rule, check_alerts, recent_history, remove_rules, suggested_threshold
from tickloom.operators.clean import (
    canonical_series, dedup_first, flag_quality, normalize_types, prepare_series, to_silver, unknown_keys,
)
from tickloom.operators.compare import correlation_matrix, normalized, returns
from tickloom.operators.filters import (
    explore, explore_counts, last_n_per_key, min_history, newest, select_keys, trailing_range,
)
from tickloom.operators.forecast import (
    actual_plus_forecast, forecast, forecast_ar, forecast_linear, forecast_summary,
)
from tickloom.operators.indicators import bollinger, indicators, ohlc, rsi, sma, technical_panel
from tickloom.operators.quantiles import exact_quantiles
from tickloom.operators.seasonal import forecast_seasonal
from tickloom.operators.signals import (
    kpi_latest, period_change, signal_text, signals, technical_cards, technical_summary,
)
from tickloom.scale import KeyProfile, profile, with_ordinal
from tickloom.schemas import GOLD_SERIES, SERIES, SILVER_SERIES, Series
from tickloom.session import build_session
