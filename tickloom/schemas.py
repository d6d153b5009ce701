"""Row shapes of the layers, and the column roles every series operator works on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

_S, _D, _TS, _L = T.StringType(), T.DoubleType(), T.TimestampType(), T.LongType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


NUMERIC_TICK_COLUMNS = ("price_usd", "market_cap_usd", "volume_24h_usd", "change_24h_pct")

# Raw JSON is read as text, so that one bad number becomes null instead of a bad record.
RAW_TEXT = _struct(
    ("coin_id", _S), ("price_usd", _S), ("market_cap_usd", _S), ("volume_24h_usd", _S),
    ("change_24h_pct", _S), ("last_updated", _S), ("fetched_at", _S),
)
BRONZE = _struct(
    ("coin_id", _S), ("price_usd", _D), ("market_cap_usd", _D), ("volume_24h_usd", _D),
    ("change_24h_pct", _D), ("last_updated", _TS), ("fetched_at", _TS),
)
SILVER = T.StructType(BRONZE.fields + [T.StructField("data_quality_flag", _S, True)])
GOLD = _struct(
    ("coin_id", _S), ("window_start", _TS), ("window_end", _TS), ("avg_price", _D),
    ("min_price", _D), ("max_price", _D), ("avg_volume", _D), ("avg_change_pct", _D),
    ("price_volatility", _D), ("record_count", _L),
)
ALERT_RULE = _struct(
    ("id", _L), ("coin", _S), ("type", _S), ("condition", _S), ("threshold", _D),
    ("active", T.BooleanType()),
)
ALERT_HISTORY = _struct(("time", _S), ("coin", _S), ("type", _S), ("message", _S))

# The keys accepted by the configuration check.
KNOWN_COINS = (
    "bitcoin", "ethereum", "solana", "cardano", "polkadot",
    "dogecoin", "ripple", "litecoin", "chainlink", "avalanche-2",
)


@dataclass(frozen=True)
class Series:
    """Names of the columns that play each role in a keyed time series.

    ``(key, ts, *tiebreak)`` must order the rows of a key totally; key and ts are not null
    (``operators.clean.prepare_series`` establishes that).
    """

    key: str = "coin_id"
    ts: str = "ts"
    value: str = "value"
    volume: str = "volume"
    change: str = "change"
    high: str = "high"
    low: str = "low"
    tiebreak: tuple[str, ...] = ()

    @property
    def order(self) -> tuple[str, ...]:
        return (self.ts, *self.tiebreak)

    def but(self, **changes) -> "Series":
        return replace(self, **changes)


SERIES = Series()
GOLD_SERIES = Series(
    ts="window_start", value="avg_price", volume="avg_volume", change="avg_change_pct",
    high="max_price", low="min_price",
)
SILVER_SERIES = Series(
    ts="fetched_at", value="price_usd", volume="volume_24h_usd", change="change_24h_pct",
    high="price_usd", low="price_usd",
)
