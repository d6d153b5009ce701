"""Every operator as a runnable query over the given tables.

``QUERIES[name]`` takes (spark, sf_dir). Results are published in one form: doubles rounded to
six digits, times as zone-less timestamps in UTC.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import columns as fn
from tickloom.operators import (
    aggregate, alerts, clean, compare, filters, forecast, indicators, seasonal, signals, sketches,
)
from tickloom.plans import medallion, supervise, views
from tickloom.plans.fixtures import PARTS, Fixtures
from tickloom.scale import with_ordinal
from tickloom.schemas import ALERT_RULE, GOLD, GOLD_SERIES, KNOWN_COINS, RAW_TEXT, SERIES, SILVER, SILVER_SERIES
from tickloom.session import scratch_path
from tickloom.sources import bucketed, layers, pruned, raw, versions
from tickloom.streaming import flows, keyed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SESSION_START = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
#: Digits of the queries whose values are exact ties at the seventh digit (a price over a quantity of
#: 32, means of eight or twenty prices): there six digits would hang on the last bit of a sum.
TIED = 8
#: Rolling means of such prices are ties at any digit; these two queries shift them off the tie.
TIE_SHIFT = 1.7e-8
AFTER_ALL = datetime(2030, 1, 1, tzinfo=timezone.utc)


def publish(df: DataFrame, digits: int = 6, shift: float = 0.0) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c + shift if shift else c, digits) + F.lit(0.0)  # + 0.0: no negative zero
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, digits: int = 6, shift: float = 0.0):
    def register(build: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: publish(build(Fixtures(spark, sf_dir)), digits, shift)
        return build

    return register


def _unused_rules(f: Fixtures) -> DataFrame:
    return f.table("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))


# --- sources and sinks ------------------------------------------------------------------

@query("scan_jsonl")
def _(f):
    path = scratch_path(f.spark, "raw")
    raw.write_raw(f.raw_text(), path)
    return clean.normalize_types(raw.read_raw(f.spark, path))


@query("flatten_snapshot")
def _(f):
    return clean.normalize_types(raw.flatten_snapshot(f.snapshots())).drop("last_updated")


@query("bronze")
def _(f):
    path = scratch_path(f.spark, "bronze")
    layers.write_layer(clean.normalize_types(f.dirty()), path, "fetched_at")
    stored = f.spark.read.parquet(path)
    return stored.select("seq", "coin_id", "price_usd", "change_24h_pct", "volume_24h_usd", "fetched_at")


@query("silver")
def _(f):
    path = scratch_path(f.spark, "silver")
    layers.write_layer(f.silver(), path, "fetched_at")
    stored = f.spark.read.parquet(path)
    return stored.select(
        "seq", "coin_id", "fetched_at", "price_usd", "change_24h_pct", "volume_24h_usd", "data_quality_flag"
    )


@query("session_csv")
def _(f):
    path = scratch_path(f.spark, "sessions")
    layers.save_session(f.gold(), f.ticks(), path, SESSION_START)
    name = SESSION_START.strftime("session_%Y%m%d_%H%M%S")
    return f.spark.read.schema(GOLD).options(**layers.CSV).csv(f"{path}/session={name}")


@query("session_latest_500")
def _(f):
    path = scratch_path(f.spark, "sessions")
    layers.save_session(f.gold(), f.ticks(), path, SESSION_START)
    newest = layers.list_sessions(f.spark, path).first()["session"]
    return layers.load_session(f.spark, path, newest, GOLD)


def _exported(f: Fixtures, df: DataFrame) -> DataFrame:
    """Through the CSV sink and back."""
    path = scratch_path(f.spark, "export")
    layers.write_csv(df, path)
    return f.spark.read.schema(df.schema).options(**layers.CSV).csv(path)


@query("export_selected")
def _(f):
    return _exported(f, layers.export_selected(f.series(), ["click", "view"], "ts", ["seq"]))


@query("export_range")
def _(f):
    return _exported(f, layers.export_range(f.series(), "24h", ["click", "view"]))


@query("retention_filter")
def _(f):
    ticks = f.ticks()
    newest = ticks.agg(F.max("fetched_at")).scalar()
    return layers.retain(ticks, "fetched_at", 36, newest).select("seq", "coin_id", "fetched_at", "price_usd")


@query("json_records")
def _(f):
    return layers.json_records(f.history(None))


@query("alerts_store")
def _(f):
    path = scratch_path(f.spark, "rules")
    layers.write_json_table(f.rules(), path)
    return layers.read_json_table(f.spark, path, ALERT_RULE)


@query("rules_saved")
def _(f):
    """Rules are saved, one is added and some are removed, each over the table as it was read."""
    table = versions.VersionedTable(f.spark, scratch_path(f.spark, "rules"), ALERT_RULE)
    table.save(f.rules())
    table.update(lambda rules: alerts.add_rule(rules, "click", "price", "above", 70.5, SESSION_START))
    table.update(lambda rules: alerts.remove_rules(rules, _unused_rules(f)))
    return table.read()


@query("layer_drift")
def _(f):
    """Two batches of one layer, of which the first has no volume."""
    path, ticks = scratch_path(f.spark, "drift"), f.ticks()
    layers.write_layer(ticks.where("seq % 2 = 0").drop("volume_24h_usd"), path, "fetched_at", 0)
    layers.write_layer(ticks.where("seq % 2 = 1"), path, "fetched_at", 1)
    return layers.read_layer(f.spark, path, SILVER).select("coin_id", "fetched_at", "price_usd", "volume_24h_usd")


def _stored_ticks(f: Fixtures) -> str:
    path = scratch_path(f.spark, "stored")
    layers.write_layer(f.ticks(), path, "fetched_at")
    return path


@query("layer_freshness")
def _(f):
    return pruned.layer_freshness(f.spark, _stored_ticks(f), SILVER, "fetched_at")


@query("layer_trailing_range")
def _(f):
    kept = pruned.layer_trailing_range(f.spark, _stored_ticks(f), SILVER, "6h", "fetched_at")
    return kept.select("coin_id", "fetched_at", "price_usd")


@query("layer_sizes")
def _(f):
    gold = scratch_path(f.spark, "stored")
    layers.write_layer(aggregate.to_gold(f.ticks(), "1 hour"), gold, "window_start")
    return pruned.layer_sizes(f.spark, {"silver": _stored_ticks(f), "gold": gold})


@query("raw_arrival")
def _(f):
    """Two raw batches; of a tick in both the one written first stays."""
    path, text = scratch_path(f.spark, "raw"), f.raw_text()
    for copies in (0, 1):
        raw.write_raw(text.where(f"seq % 2 = {copies}").repartitionByRange(_files(f), "seq").sortWithinPartitions("seq"), path)
    ticks = clean.normalize_types(raw.read_raw(f.spark, path, with_arrival=True))
    return clean.to_silver(ticks, raw.ARRIVAL.fieldNames()).select(
        "coin_id", "fetched_at", "price_usd", "change_24h_pct", "volume_24h_usd", "data_quality_flag"
    )


@query("cycle_incremental")
def _(f):
    """Hourly gold after one cycle for each slice of dirty raw ticks."""
    path, out = scratch_path(f.spark, "raw"), scratch_path(f.spark, "layers")
    for i, part in enumerate(_slices(f, f.raw_text(), SLICES)):
        for copies in (0, 1):
            raw.write_raw(part.where(f"seq % 2 = {copies}"), path)
        medallion.run_cycle(f.spark, path, out, i, "1 hour")
    return medallion.read_gold(f.spark, out)


@query("cycle_log")
def _(f):
    """What each cycle stored, as the log of the cycles has it."""
    path, out, log = (scratch_path(f.spark, name) for name in ("raw", "layers", "log"))
    for i, part in enumerate(_slices(f, f.raw_text(), 2)):
        raw.write_raw(part, path)
        supervise.supervised_cycle(f.spark, path, out, i, log, width="1 hour")
    supervise.supervised_cycle(f.spark, path, out, 2, log, width="1 hour")
    return supervise.EventLog(f.spark, log, supervise.CYCLE).read().select(
        "batch_id", "status", "bronze_rows", "silver_rows", "gold_windows", "error"
    )


@query("cycle_widths")
def _(f):
    """Windows that cross midnight, and the borders of the cycles."""
    path, text = scratch_path(f.spark, "raw"), f.raw_text()
    outs = {width: scratch_path(f.spark, "layers") for width in ("7 minutes", "2 days")}
    for i, part in enumerate(_slices(f, text, 2)):
        raw.write_raw(part, path)
        for width, out in outs.items():
            medallion.run_cycle(f.spark, path, out, i, width)
    frames = [medallion.read_gold(f.spark, out).withColumn("width", F.lit(width)) for width, out in outs.items()]
    return frames[0].unionByName(frames[1])


# --- cleaning ---------------------------------------------------------------------------

@query("normalize_types")
def _(f):
    kept = ["seq", "coin_id", "price_usd", "market_cap_usd", "volume_24h_usd", "change_24h_pct", "fetched_at"]
    return clean.normalize_types(f.raw_text()).select(*kept)


@query("prepare_series")
def _(f):
    prepared = clean.prepare_series(f.dirty(), "fetched_at", "price_usd", ["volume_24h_usd", "change_24h_pct"])
    return prepared.select("seq", "coin_id", "fetched_at", "price_usd", "volume_24h_usd", "change_24h_pct")


@query("canonical_series")
def _(f):
    return clean.canonical_series(f.gold(), f.silver())


@query("tz_shift")
def _(f):
    return f.series().select("seq", "coin_id", fn.shift_minutes("ts", -330).alias("local_ts"))


@query("quality_flag")
def _(f):
    flagged = clean.flag_quality(f.dirty())
    return flagged.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("rows"))


@query("unknown_keys")
def _(f):
    """Requested ids come from comma-separated lists, one list per order."""
    asked = clean.split_keys(
        f.rules().select(F.concat_ws(" , ", F.col("coin"), F.lit("bitcoin"), F.lit("solana")).alias("ids")), "ids"
    )
    known = f.spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in KNOWN_COINS])).alias("coin_id"))
    return clean.unknown_keys(asked, known)


@query("direction_label")
def _(f):
    shown = f.dirty().select(
        fn.direction("change_24h_pct").alias("change_direction"),
        fn.direction("change_24h_pct", null_as="up").alias("volume_direction"),
    )
    return shown.groupBy("change_direction", "volume_direction").agg(F.count(F.lit(1)).alias("rows"))


@query("volatility_series")
def _(f):
    return aggregate.volatility_series(f.hourly())


@query("volatility_series_silver")
def _(f):
    return aggregate.volatility_series(f.ticks(), "silver")


@query("dedup_first")
def _(f):
    usable = clean.drop_unusable(clean.normalize_types(f.dirty()))
    return clean.dedup_first(usable, ["coin_id", "fetched_at"], ["seq"]).select("seq", "coin_id", "fetched_at", "price_usd")


# --- filters, top-k ---------------------------------------------------------------------

@query("select_keys")
def _(f):
    return filters.select_keys(f.series(), ["click", "purchase"]).select("seq", "coin_id", "ts", "value")


@query("trailing_range")
def _(f):
    return filters.trailing_range(f.series(), "6h").select("seq", "coin_id", "ts", "value")


@query("session_range")
def _(f):
    """A session that has rows, and one that has none and shows the last half hour."""
    def rows(start, label):
        kept = filters.trailing_range(f.series(), "session", session_start=start)
        return kept.select("seq", "coin_id", "ts", F.lit(label).alias("kind"))

    return rows(SESSION_START, "rows").unionByName(rows(AFTER_ALL, "fallback"))


@query("min_history", digits=TIED)
def _(f):
    return filters.min_history(f.parts(), 30, PARTS).select("coin_id", "ts", "l_orderkey", "l_linenumber", "value")


@query("recent_20")
def _(f):
    return filters.newest(f.series(), 20, "ts", ["seq"])


@query("explorer_500")
def _(f):
    return filters.explore(f.series(), ["click", "view", "error"], "24h", tiebreak=["seq"])


@query("explorer_counts")
def _(f):
    return filters.explore_counts(f.series(), ["click", "view", "error"], "24h")


@query("ordinal")
def _(f):
    return with_ordinal(f.series()).select("coin_id", "ts", "seq", "ordinal")


# --- aggregation ------------------------------------------------------------------------

@query("gold_10s")
def _(f):
    path = scratch_path(f.spark, "gold")
    layers.write_layer(aggregate.to_gold(f.silver()), path, "window_start", mode="overwrite_dates")
    return layers.read_layer(f.spark, path, GOLD)


@query("gold_1h")
def _(f):
    return aggregate.to_gold(f.silver(), "1 hour")


def _resample(interval: str):
    @query(f"resample_{interval}")
    def _(f):
        return aggregate.resample(f.gold(), interval)


for _interval in fn.INTERVALS:
    _resample(_interval)


@query("overview")
def _(f):
    return views.overview(f.gold(), ["click", "view"], "15m", "24h")


@query("status_by_key")
def _(f):
    return aggregate.status_by_key(f.series())


@query("freshness")
def _(f):
    return aggregate.freshness(f.series())


@query("layer_counts")
def _(f):
    return aggregate.layer_counts(f.gold("1 hour"), f.silver())


@query("keys_union")
def _(f):
    return aggregate.keys_union(f.gold("1 hour"), f.silver())


@query("volume_total")
def _(f):
    return aggregate.volume_total(f.series())


@query("price_distribution")
def _(f):
    return aggregate.distribution(f.series(), "value")


@query("price_distribution_stored")
def _(f):
    """From daily sketches that two batches have stored."""
    store, ticks = sketches.sketch_store(f.spark, scratch_path(f.spark, "sketches")), f.ticks()
    for i in range(2):
        store.write(sketches.daily_sketches(ticks.where(f"seq % 2 = {i}")), i)
    return sketches.stored_distribution(store, ticks)


@query("returns_distribution")
def _(f):
    return aggregate.returns_distribution(compare.returns(f.series()), SERIES)


@query("sampling_interval")
def _(f):
    return aggregate.sampling_interval(f.series())


@query("correlation_matrix")
def _(f):
    return compare.correlation_matrix(f.series())


@query("correlation_time")
def _(f):
    return compare.correlation_matrix(f.series(), by=SERIES, align="time", bucket="1 hour", method="chunked")


@query("correlation_12")
def _(f):
    """More keys than the pivot takes."""
    return compare.correlation_matrix(f.supplier_series(), by=PARTS, align="time", bucket="1 day", method="wide")


# --- indicators and signals -------------------------------------------------------------

_ROW = ["coin_id", "ts", "seq"]


def _sma(window: int):
    @query(f"sma_{window}")
    def _(f):
        return indicators.sma(f.series(), window, SERIES).select(*_ROW, f"sma_{window}")


for _window in (10, 20):
    _sma(_window)


@query("bucketed_panel")
def _(f):
    """Silver in buckets by key: indicators of a table that is not shuffled for them."""
    table = f"bucketed_{uuid.uuid4().hex}"
    kept = f.ticks().select("coin_id", "fetched_at", "price_usd", "change_24h_pct", "seq")
    stored = bucketed.write_bucketed(kept, table, scratch_path(f.spark, "buckets"), 8, order=["fetched_at", "seq"])
    return indicators.indicators(stored, SILVER_SERIES.but(tiebreak=("seq",))).select(
        "coin_id", "fetched_at", "seq", "sma_10", "sma_20", "bb_upper", "bb_lower", "rsi_14"
    )


@query("bollinger")
def _(f):
    return indicators.bollinger(f.series()).select(*_ROW, "bb_middle", "bb_upper", "bb_lower")


@query("rsi_14")
def _(f):
    return indicators.rsi(f.series()).select(*_ROW, "rsi_14")


@query("ohlc")
def _(f):
    return indicators.ohlc(f.hourly(), GOLD_SERIES, f.tick_profile()).select(
        "coin_id", "window_start", "open", "close", "candle_high", "candle_low"
    )


@query("normalized_price")
def _(f):
    return compare.normalized(f.series()).select(*_ROW, "normalized")


@query("returns_pct")
def _(f):
    return compare.returns(f.series()).select("coin_id", "ts", "return_pct")


@query("kpi_latest")
def _(f):
    return signals.kpi_latest(f.series())


@query("latest_per_key", digits=TIED)
def _(f):
    return aggregate.latest_per_key(f.parts(), PARTS)


@query("period_change")
def _(f):
    return signals.period_change(f.series())


_PANEL = ["open", "close", "candle_high", "candle_low", "sma_10", "sma_20", "bb_middle", "bb_upper", "bb_lower", "rsi_14", "volume_direction"]


@query("technical_panel", digits=TIED)
def _(f):
    panel = views.technical(f.gold(), interval="1h", time_range="all", size=f.tick_profile())
    return panel.select("coin_id", "window_start", *_PANEL)


@query("technical_panel_parts", shift=TIE_SHIFT)
def _(f):
    rows = indicators.technical_panel(f.parts(), PARTS)
    return rows.select("coin_id", "ts", "l_orderkey", "l_linenumber", *_PANEL)


@query("technical_summary", digits=4, shift=TIE_SHIFT)
def _(f):
    return signals.technical_summary(f.parts(), PARTS)


_SIGNALS = ["coin_id", "rsi_signal", "bb_signal", "ma_signal", "rsi_score", "bb_score", "ma_score", "total_score", "recommendation"]


@query("signals")
def _(f):
    return signals.signals(f.parts(), PARTS).select(*_SIGNALS)


@query("signals_hourly")
def _(f):
    return views.technical_cards(f.gold(), "1h").select(*_SIGNALS, "rsi_zone", "bb_width", "period_change_pct")


@query("signal_text")
def _(f):
    """The texts quote the published numbers."""
    return signals.signal_text(publish(signals.signals(f.hourly(), GOLD_SERIES)), GOLD_SERIES)


# --- alerts -----------------------------------------------------------------------------

@query("alerts_fired")
def _(f):
    return alerts.check_alerts(f.series(), f.rules(), SERIES, SESSION_START)


@query("alerts_remove")
def _(f):
    return alerts.remove_rules(f.rules(), _unused_rules(f))


@query("alerts_add")
def _(f):
    return alerts.add_rule(f.rules(), "click", "price", "above", 70.5, SESSION_START)


@query("alert_suggested_threshold")
def _(f):
    return alerts.suggested_threshold(f.rules().select(F.col("coin").alias("coin_id")), f.series(), SERIES)


@query("alert_history_50")
def _(f):
    return alerts.recent_history(f.history(), "seq")


@query("alert_last_3")
def _(f):
    return alerts.recent_history(f.history(), "seq", 3)


# --- forecasts --------------------------------------------------------------------------

@query("forecast_linear")
def _(f):
    return forecast.forecast_linear(f.hourly(), size=f.tick_profile())


@query("forecast_ar")
def _(f):
    return forecast.forecast_ar(f.series(), by=SERIES)


@query("forecast_ar_parts")
def _(f):
    return forecast.forecast_ar(f.parts(), by=PARTS)


@query("forecast_seasonal")
def _(f):
    return seasonal.forecast_seasonal(f.hourly(), size=f.tick_profile())


@query("forecast_seasonal_frame")
def _(f):
    """Keys, steps, times and methods of the seasonal forecast; a key with a missing volume is linear."""
    ahead = seasonal.forecast_seasonal(f.gappy(), size=f.tick_profile())
    return ahead.select("coin_id", "step", "window_start", "method")


@query("forecast_seasonal_line", digits=4)
def _(f):
    """Prices on a line, whatever the volume: the seasonal model continues the line."""
    hours = F.unix_micros(F.col("window_start").cast("timestamp")) / 3.6e9
    line = f.hourly().withColumn("avg_price", F.lit(0.25) * (hours - F.lit(473352.0)) + F.length("coin_id"))
    return seasonal.forecast_seasonal(line, size=f.tick_profile())


@query("forecast_summary")
def _(f):
    hourly = f.hourly()
    return forecast.forecast_summary(forecast.forecast_linear(hourly, size=f.tick_profile()), hourly)


@query("actual_plus_forecast")
def _(f):
    hourly = f.hourly()
    return forecast.actual_plus_forecast(forecast.forecast_linear(hourly, size=f.tick_profile()), hourly)


# --- streaming --------------------------------------------------------------------------

#: Batches that land one after another, and events that a file of one holds at most, or nearly so.
SLICES, SLICE_ROWS = 4, 1_000_000


def _slices(f: Fixtures, text: DataFrame, n: int) -> list[DataFrame]:
    """Raw rows in ``n`` parts by time; rows without a time come with the first.

    All parts are written in one pass over the rows, and each is read from its own folder.
    """
    at = F.col("fetched_at").cast("timestamp")
    low, high = f.ticks().agg(F.min("fetched_at"), F.max("fetched_at")).first()
    done, span = F.unix_micros(at) - F.unix_micros(F.lit(low)), F.unix_micros(F.lit(high)) - F.unix_micros(F.lit(low)) + 1
    part = F.coalesce(F.floor(done * n / span), F.lit(0))
    path, sliced = scratch_path(f.spark, "slices"), text.withColumn("_slice", part.cast("int"))
    sliced.write.partitionBy("_slice").parquet(path)
    stored, files = f.spark.read.schema(sliced.schema).parquet(path), _files(f)
    return [
        stored.where(F.col("_slice") == i).drop("_slice").repartitionByRange(files, "seq").sortWithinPartitions("seq")
        for i in range(n)
    ]


def _files(f: Fixtures) -> int:
    """Files of a landed slice; a micro-batch takes as many, so neither is one task on a large table."""
    return max(1, -(-f.ticks().count() // SLICE_ROWS))


def _landed(f: Fixtures, text: DataFrame, name: str, copies: bool = False) -> str:
    """Raw batches in order of time. With ``copies`` odd ``seq`` rows are a later batch of their slice."""
    path = scratch_path(f.spark, name)
    for part in _slices(f, text, SLICES):
        for batch in ([part.where("seq % 2 = 0"), part.where("seq % 2 = 1")] if copies else [part]):
            raw.write_raw(batch, path)
    return path


def _clean_text(f: Fixtures) -> DataFrame:
    iso = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return f.ticks().withColumn("fetched_at", iso)


def _tick_stream(f: Fixtures) -> DataFrame:
    """Clean ticks, landed as JSON lines and read back as a typed stream, a micro-batch for each slice."""
    return clean.normalize_types(flows.read_raw_stream(f.spark, _landed(f, _clean_text(f), "landing"), RAW_TEXT, _files(f)))


def _finish(f: Fixtures, stream: DataFrame, name: str) -> str:
    """Run an append stream over everything that has landed; the folder of its output."""
    out = scratch_path(f.spark, name)
    flows.append_to(stream, out, scratch_path(f.spark, "cp"), None).awaitTermination()
    return out


@query("stream_dedup")
def _(f):
    """Every slice is delivered twice; the second copy leaves no trace."""
    path = scratch_path(f.spark, "landing")
    for part in _slices(f, _clean_text(f), SLICES):
        for _ in range(2):
            raw.write_raw(part, path)
    out = _finish(f, flows.silver_stream(flows.read_raw_stream(f.spark, path, files_per_batch=_files(f))), "silver")
    return layers.read_layer(f.spark, out, SILVER).select(
        "coin_id", "fetched_at", "price_usd", "change_24h_pct", "data_quality_flag"
    )


#: Late copies of a slice come after all of it, so the streams of dirty ticks wait longer than a slice.
SLICE_LATENESS = "12 days"


@query("stream_silver")
def _(f):
    """Dirty ticks with and without a time, several micro-batches, as the batch layer cleans them."""
    path = _landed(f, f.raw_text(), "landing", copies=True)

    def source():
        return flows.read_raw_stream(f.spark, path, files_per_batch=_files(f))

    dated = _finish(f, flows.silver_stream(source(), SLICE_LATENESS), "silver")
    undated = scratch_path(f.spark, "undated")
    sink = flows.undated_sink(f.spark, undated, scratch_path(f.spark, "known"))
    flows.each_batch(flows.usable_ticks(source()), sink, scratch_path(f.spark, "cp"), interval=None).awaitTermination()
    both = layers.read_layer(f.spark, dated, SILVER).unionByName(layers.read_layer(f.spark, undated, SILVER))
    return both.select("coin_id", "fetched_at", "price_usd", "change_24h_pct", "volume_24h_usd", "data_quality_flag")


@query("stream_pipeline")
def _(f):
    """Dirty raw files -> silver -> gold in one query of several micro-batches."""
    path = _landed(f, f.raw_text(), "landing", copies=True)

    def silver():
        return flows.silver_stream(flows.read_raw_stream(f.spark, path, files_per_batch=_files(f)), SLICE_LATENESS)

    stored = layers.read_layer(f.spark, _finish(f, silver(), "silver"), SILVER)
    final = layers.read_layer(f.spark, _finish(f, flows.gold_stream(silver(), "1 hour"), "gold"), GOLD)
    return flows.with_open_bins(final, stored, lambda s: aggregate.to_gold(s, "1 hour"), "1 hour")


@query("stream_gold")
def _(f):
    out = scratch_path(f.spark, "gold")
    windows = flows.gold_stream(flows.timed(_tick_stream(f)), "1 hour")
    flows.each_batch(windows, flows.upsert_windows(out), scratch_path(f.spark, "cp"), "update", None).awaitTermination()
    return flows.read_upserts(f.spark, out)


@query("stream_resample")
def _(f):
    out = _finish(f, flows.resample_stream(flows.timed(_tick_stream(f)), "1h"), "bins")
    bins = f.spark.read.parquet(out)
    return flows.with_open_bins(bins, f.ticks(), lambda s: aggregate.resample(aggregate.to_gold(s), "1h"), "1 hour")


@query("stream_alerts")
def _(f):
    """What the last of several checks fires."""
    out = scratch_path(f.spark, "history")
    sink = flows.alert_sink(f.spark, f.rules, out, scratch_path(f.spark, "latest"))
    flows.each_batch(_tick_stream(f), sink, scratch_path(f.spark, "cp"), interval=None).awaitTermination()
    fired = f.spark.read.parquet(out)
    newest = fired.agg(F.max(layers.BATCH)).scalar()
    return fired.where(F.col(layers.BATCH) == newest).select("id", "coin", "type", "message")


@query("stream_indicators")
def _(f):
    done = f.spark.read.parquet(_finish(f, keyed.indicator_stream(_tick_stream(f)), "indicators"))
    return done.select("coin_id", "fetched_at", "sma_10", "sma_20", "bb_upper", "bb_lower", "rsi_14")


@query("stream_dedup_first")
def _(f):
    """Different copies of a tick, many of them in one micro-batch: the first to arrive stays."""
    path = scratch_path(f.spark, "landing")
    for part in _slices(f, f.raw_text(), 2):
        raw.write_raw(part, path)
    stream = flows.read_raw_stream(f.spark, path, files_per_batch=2 * _files(f), with_arrival=True)
    out = _finish(f, flows.silver_stream(stream, SLICE_LATENESS), "silver")
    return layers.read_layer(f.spark, out, SILVER).select(
        "coin_id", "fetched_at", "price_usd", "change_24h_pct", "volume_24h_usd", "data_quality_flag"
    )
