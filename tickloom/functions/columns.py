"""Scalar column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Resampling intervals. "1m" is accepted and leaves the series as it is.
INTERVALS = {"5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour"}


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def number(c) -> Column:
    """Numeric coercion: unparsable text and NaN become null."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def moment(c) -> Column:
    """Timestamp coercion: unparsable text becomes null."""
    return col(c).try_cast("timestamp")


def percent_change(new, old) -> Column:
    """(new - old) / old in percent; null when ``old`` is 0 or null."""
    return F.try_divide(col(new) - col(old), col(old)) * 100


def quality_flag(change, low: float = -100.0, high: float = 1000.0) -> Column:
    """``good`` inside [low, high]; anything else, null included, is ``suspicious``."""
    return F.when(col(change).between(low, high), "good").otherwise("suspicious")


def direction(change, null_as: str = "down") -> Column:
    """``up`` for change >= 0, else ``down``; ``null_as`` says how a null counts."""
    c = col(change)
    if null_as == "up":
        c = F.coalesce(c, F.lit(0.0))
    return F.when(c >= 0, "up").otherwise("down")


def shift_minutes(ts, tz_offset_minutes: int) -> Column:
    """Local display time for a browser-style offset (minutes behind UTC are positive)."""
    return col(ts) - F.make_interval(mins=F.lit(int(tz_offset_minutes)))


def micros(ts) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def shorten_number(c) -> Column:
    """A double as plain decimal text without an exponent: 70000.0, 12345678.9, 5.0."""
    x = col(c)
    text = F.regexp_replace(F.format_string("%.10f", x), r"(\.\d+?)0+$", "$1")
    return F.when(x.isNotNull(), text)


#: Seconds of the units of a range label.
UNITS = {"m": 60, "h": 3600}
_LABEL = re.compile(r"(\d+)([mh])")


def seconds_of(time_range: str) -> int | None:
    """Seconds in a range label, a number and a unit such as "30m" or "6h"; None for any other label."""
    label = _LABEL.fullmatch(str(time_range))
    return int(label[1]) * UNITS[label[2]] if label else None


def box_statistics(value) -> list[Column]:
    """Count, mean, sample deviation and extremes of a value, ready for ``agg``."""
    v = col(value)
    return [
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    ]
