"""Stateful stream operators: what they know of a key lies in the state store, and a batch reads and
writes the keys that it brings, however many others there are.

A processor gets a key's rows of a micro-batch at once, so the trigger's size (``files_per_batch``)
bounds what one task holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.indicators import ALL_HALO, BAND_WIDTH, BAND_WINDOW, RSI_PERIOD
from tickloom.schemas import SILVER_SERIES, Series
from tickloom.sources.raw import ARRIVAL

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Streams that start from now on keep their state in RocksDB, which keyed state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# --- first copies

#: Times of a key that share a state: a state is read and written once for all of them.
SPAN = "1 hour"


def number_lines(rows: DataFrame) -> DataFrame:
    """``arrival_line``: the place of a row among those that its task reads, in file order."""
    names = [c for c in rows.columns if c != "arrival_line"]

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            own = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*names, "arrival_line"])

    kept = rows.select(*names)
    return kept.mapInArrow(lines, T.StructType([*kept.schema.fields, T.StructField("arrival_line", T.LongType(), True)]))


class FirstCopies(StatefulProcessor):
    """Of the rows of a key and time the first to arrive, once. The times that were seen are one value
    for each key and span; it goes when the watermark has passed the span."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "times array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows), ignore_index=True)
        own["_at"] = own["fetched_at"].to_numpy().astype("datetime64[us]").astype(np.int64)
        own = own.sort_values(["_at", *ARRIVAL.fieldNames()], kind="stable").drop_duplicates("_at")
        known = self.seen.get()
        before = np.array(known[0] if known else [], np.int64)
        new = own[~own["_at"].isin(before)]
        if not known:
            self.handle.registerTimer(int(key[-1]) // 1000)
        if len(new):
            self.seen.update((np.union1d(before, new["_at"]).tolist(),))
            yield new[self.names]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_copies(ticks: DataFrame, span: str = SPAN) -> DataFrame:
    """The first copy of each (coin_id, fetched_at) of a watermarked stream, in order of arrival: file,
    block, line. Copies in one micro-batch are told apart by that order, later ones by the state."""
    use_state_store(ticks.sparkSession)
    names = [c for c in ticks.columns if c not in ARRIVAL.fieldNames()]
    schema = T.StructType([ticks.schema[c] for c in names])
    end = F.unix_micros(F.window("fetched_at", span)["end"])
    return ticks.withColumn("_span_end", end).groupBy("coin_id", "_span_end").transformWithStateInPandas(
        FirstCopies(names), schema, "append", "eventTime", eventTimeColumnName="fetched_at"
    )


# --- indicators

def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """(n - width + 1, width) windows."""
    return sliding_window_view(values, width) if len(values) >= width else np.zeros((0, width))


def _whole(windows: np.ndarray, measured: np.ndarray, rows: int) -> np.ndarray:
    """The last ``rows`` measures, missing where a window isn't full of values."""
    out = np.full(rows, np.nan)
    ok = ~np.isnan(windows).any(1)
    use = min(rows, len(measured))
    if use:
        out[rows - use :] = np.where(ok, measured, np.nan)[len(measured) - use :]
    return out


def panel_columns(values: np.ndarray, rows: int) -> dict[str, np.ndarray]:
    """The indicators of the last ``rows`` values; those before them are their history."""
    out = {}
    before = np.concatenate(([np.nan], values[:-1]))[len(values) - rows :]
    out["open"] = np.where(np.isnan(before), values[len(values) - rows :], before)
    out["close"] = values[len(values) - rows :]
    for w in (10, BAND_WINDOW):
        windows = _rolling(values, w)
        out[f"sma_{w}"] = _whole(windows, windows.mean(1), rows)
    windows = _rolling(values, BAND_WINDOW)
    spread = _whole(windows, windows.std(1, ddof=1) * BAND_WIDTH, rows)
    middle = out[f"sma_{BAND_WINDOW}"]
    out |= {"bb_middle": middle, "bb_upper": middle + spread, "bb_lower": middle - spread}
    steps = _rolling(np.diff(values), RSI_PERIOD)
    gain, loss = np.where(steps > 0, steps, 0.0).mean(1), np.where(steps < 0, -steps, 0.0).mean(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        strength = np.where(loss > 0, 100 - 100 / (1 + gain / loss), np.nan)
    out[f"rsi_{RSI_PERIOD}"] = _whole(steps, strength, rows)
    return out


class RecentRows(StatefulProcessor):
    """Indicators behind the last rows of a key, which are its state."""

    def __init__(self, by: Series, names: list[str], kinds: list[str]):
        self.by, self.names, self.kinds = by, names, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        places = ", ".join(f"`{c}` {'bigint' if c == self.by.ts else kind}" for c, kind in zip(self.by.order, self.kinds, strict=True))
        self.recent = handle.getValueState("recent", f"values array<double>, {places}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        by = self.by
        own = pd.concat(list(rows), ignore_index=True).sort_values(list(by.order), kind="stable", ignore_index=True)
        places = [own[by.ts].to_numpy().astype("datetime64[us]").astype(np.int64), *(own[c].to_numpy() for c in by.tiebreak)]
        known = self.recent.get()
        history = np.zeros(0)
        if known:
            history = np.array([np.nan if v is None else v for v in known[0]], float)
            # Rows before the last one are late; those of its very place follow it.
            late, equal = np.zeros(len(own), bool), np.ones(len(own), bool)
            for column, last in zip(places, known[1:], strict=True):
                late |= equal & (column < last)
                equal &= column == last
            own, places = own[~late], [p[~late] for p in places]
        if not len(own):
            return
        values = np.concatenate((history, own[by.value].to_numpy(dtype=float, na_value=np.nan)))
        for name, column in panel_columns(values, len(own)).items():
            own[name] = column
        high = own[by.high] if by.high in own else own[by.value]
        low = own[by.low] if by.low in own else own[by.value]
        own["candle_high"] = pd.concat([high, own["open"], own["close"]], axis=1).max(axis=1)
        own["candle_low"] = pd.concat([low, own["open"], own["close"]], axis=1).min(axis=1)
        kept = [None if np.isnan(v) else float(v) for v in values[-ALL_HALO:]]
        self.recent.update((kept, *(p[-1].item() if hasattr(p[-1], "item") else p[-1] for p in places)))
        yield own[self.names]

    def close(self) -> None:
        pass


PANEL = ("open", "close", "candle_high", "candle_low", "sma_10", f"sma_{BAND_WINDOW}", "bb_middle", "bb_upper", "bb_lower", f"rsi_{RSI_PERIOD}")


def indicator_stream(ticks: DataFrame, by: Series = SILVER_SERIES) -> DataFrame:
    """Every row of a stream with the indicators behind it; the newest ``ALL_HALO`` values of a key are kept.

    Rows of a micro-batch are ordered by time and tie-break. Rows before the last processed one of
    their key are late and dropped; a row of equal time and tie-break follows it.
    """
    use_state_store(ticks.sparkSession)
    kept = [c for c in dict.fromkeys([by.key, *by.order, by.value, by.change, by.high, by.low]) if c in ticks.columns]
    own = ticks.select(*kept)
    kinds = dict(own.dtypes)
    schema = T.StructType([*own.schema.fields, *(T.StructField(c, T.DoubleType(), True) for c in PANEL)])
    return own.groupBy(by.key).transformWithStateInPandas(
        RecentRows(by, schema.fieldNames(), [kinds[c] for c in by.order]), schema, "append", "none"
    )
