import itertools
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.aggregate import resample, to_gold
from tickloom.operators.clean import normalize_types, to_silver
from tickloom.operators.indicators import indicators
from tickloom.schemas import ALERT_RULE, GOLD, RAW_TEXT, SILVER, SILVER_SERIES
from tickloom.sources.layers import read_layer
from tickloom.streaming import flows, keyed

START = datetime(2024, 1, 1)


def tick(coin, minutes, price):
    at = (START + timedelta(minutes=minutes)).isoformat() + "+00:00"
    return {"coin_id": coin, "price_usd": price, "volume_24h_usd": 2.0, "change_24h_pct": 1.0, "fetched_at": at}


_modified = itertools.count(1_700_000_000)


def land(folder, name, ticks):
    """Files arrive in the order of the calls: the source goes by modification time."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(t) + "\n" for t in ticks))
    at = next(_modified)
    os.utime(folder / name, (at, at))


def batches(n=4, size=15):
    return [[tick(c, 1 * (b * size + i), 100 + (7 * (b * size + i)) % 11 + len(c)) for i in range(size) for c in ("a", "bb")] for b in range(n)]


def run_silver(spark, tmp_path, lateness="1 hour"):
    landed = flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1)
    flows.append_to(flows.silver_stream(landed, lateness), f"{tmp_path}/silver", f"{tmp_path}/cp", None).awaitTermination()
    return read_layer(spark, f"{tmp_path}/silver", SILVER)


def batch_silver(spark, tmp_path):
    return to_silver(normalize_types(spark.read.schema(RAW_TEXT).json(str(tmp_path / "raw"))), ["price_usd"])


def test_silver_equals_batch_and_ignores_replayed_files(spark, tmp_path, rows):
    for i, ticks in enumerate(batches()):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
    silver = run_silver(spark, tmp_path)
    assert rows(silver) == rows(batch_silver(spark, tmp_path).select(*silver.columns))
    land(tmp_path / "raw", "9-replay.jsonl", batches()[3])
    assert run_silver(spark, tmp_path).count() == silver.count() == 120


def test_ticks_behind_the_watermark_are_dropped(spark, tmp_path):
    land(tmp_path / "raw", "0.jsonl", [tick("a", 0, 1.0)])
    run_silver(spark, tmp_path)
    land(tmp_path / "raw", "1.jsonl", [tick("a", 600, 2.0)])
    run_silver(spark, tmp_path)
    land(tmp_path / "raw", "2.jsonl", [tick("a", 550, 3.0), tick("a", 100, 4.0)])
    assert sorted(r.price_usd for r in run_silver(spark, tmp_path).collect()) == [1.0, 2.0, 3.0]


def test_unreadable_lines_do_not_stop_the_stream(spark, tmp_path):
    land(tmp_path / "raw", "0.jsonl", [tick("a", 0, 1.0)])
    with open(tmp_path / "raw" / "0.jsonl", "a") as f:
        f.write('{"coin_id": "b", "pri')
    assert run_silver(spark, tmp_path).count() == 1


def test_gold_updates_equal_batch_gold(spark, tmp_path, rows):
    for i, ticks in enumerate(batches()):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
    ticks = normalize_types(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
    windows = flows.gold_stream(flows.timed(ticks), "7 minutes")  # windows that span two files
    sink = flows.upsert_windows(f"{tmp_path}/gold")
    flows.each_batch(windows, sink, f"{tmp_path}/cp", "update", None).awaitTermination()
    gold = flows.read_upserts(spark, f"{tmp_path}/gold").select(*GOLD.fieldNames())
    assert rows(gold) == rows(to_gold(batch_silver(spark, tmp_path), "7 minutes"))


@pytest.mark.parametrize("block_rows", [None, 10])
def test_indicators_carry_over_batches(spark, tmp_path, rows, block_rows):
    for i, ticks in enumerate(batches()):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
    if block_rows:
        spark.conf.set("tickloom.block.rows", str(block_rows))
    try:
        ticks = normalize_types(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
        sink = flows.indicator_sink(spark, f"{tmp_path}/out", f"{tmp_path}/state")
        flows.each_batch(ticks, sink, f"{tmp_path}/cp", interval=None).awaitTermination()
    finally:
        spark.conf.unset("tickloom.block.rows")
    names = ["coin_id", "fetched_at", "open", "sma_10", "sma_20", "bb_upper", "bb_lower", "rsi_14"]
    wanted = indicators(batch_silver(spark, tmp_path), SILVER_SERIES).select(*names)
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(*names), 7) == rows(wanted, 7)


def test_a_repeated_batch_replaces_its_output(spark, tmp_path, rows):
    sink = flows.indicator_sink(spark, f"{tmp_path}/out", f"{tmp_path}/state")
    ticks = [normalize_types(spark.createDataFrame([(t["coin_id"], str(t["price_usd"]), "1", "1", t["fetched_at"]) for t in b],
             "coin_id string, price_usd string, volume_24h_usd string, change_24h_pct string, fetched_at string")) for b in batches(3)]
    for i, batch in enumerate(ticks):
        sink(batch, i)
    once = rows(spark.read.parquet(f"{tmp_path}/out").drop("batch_id"))
    sink(ticks[2], 2)
    assert rows(spark.read.parquet(f"{tmp_path}/out").drop("batch_id")) == once and len(once) == 90


def test_rules_are_read_again_for_every_batch(spark, tmp_path):
    for i, ticks in enumerate(batches(2)):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
    calls = []

    def rules():
        calls.append(1)
        return spark.createDataFrame([(len(calls), "a", "price", "above", 1.0, True)], ALERT_RULE)

    ticks = normalize_types(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
    flows.each_batch(ticks, flows.alert_sink(spark, rules, f"{tmp_path}/history", f"{tmp_path}/latest"), f"{tmp_path}/cp", interval=None).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/history").collect()) == [1, 2]


@pytest.mark.parametrize("chain", ["gold", "bins"])
def test_the_streaming_layers_chain(spark, tmp_path, rows, chain):
    """raw -> silver -> gold (-> bins) in one query; the last windows come from the silver table."""
    for i, ticks in enumerate(batches()):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
        land(tmp_path / "raw", f"{i}-copy.jsonl", [{**t, "price_usd": t["price_usd"] + 50} for t in ticks[::3]])

    def source():
        return flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1)

    silver = run_silver(spark, tmp_path)
    assert silver.count() == 120
    if chain == "gold":
        stream, width = flows.gold_stream(flows.silver_stream(source(), "5 minutes"), "7 minutes"), "7 minutes"
        build = lambda s: to_gold(s, "7 minutes")
    else:
        stream, width = flows.resample_stream(flows.silver_stream(source(), "5 minutes"), "15m", "1 minute"), "15 minutes"
        build = lambda s: resample(to_gold(s, "1 minute"), "15m")
    flows.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/cp2", None).awaitTermination()
    final = spark.read.parquet(f"{tmp_path}/out")
    wanted = build(silver)
    assert 0 < final.count() < wanted.count()
    got = flows.with_open_bins(final, silver, build, width)
    assert rows(got) == rows(wanted.select(*got.columns))
    nothing = final.where("false")
    assert rows(flows.with_open_bins(nothing, silver, build, width)) == rows(wanted.select(*got.columns))


def test_ticks_without_a_time_are_kept_once(spark, tmp_path):
    undated = lambda coin, price: {**tick(coin, 0, price), "fetched_at": None}
    land(tmp_path / "raw", "0.jsonl", [undated("a", 1.0), tick("a", 0, 2.0), undated("a", 9.0)])
    land(tmp_path / "raw", "1.jsonl", [undated("a", 3.0), undated("b", 4.0), tick("a", 600, 5.0)])
    land(tmp_path / "raw", "2.jsonl", [undated("b", 6.0), undated("a", 7.0)])
    ticks = flows.usable_ticks(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
    sink = flows.undated_sink(spark, f"{tmp_path}/undated", f"{tmp_path}/known")
    flows.each_batch(ticks, sink, f"{tmp_path}/cp-undated", interval=None).awaitTermination()
    assert sorted((r.coin_id, r.price_usd) for r in read_layer(spark, f"{tmp_path}/undated", SILVER).collect()) == [("a", 1.0), ("b", 4.0)]
    assert sorted(r.price_usd for r in run_silver(spark, tmp_path).collect()) == [2.0, 5.0]


def test_rules_see_the_newest_row_of_quiet_keys(spark, tmp_path):
    land(tmp_path / "raw", "0.jsonl", [tick("a", 0, 5.0), tick("b", 0, 1.0)])
    land(tmp_path / "raw", "1.jsonl", [tick("b", 1, 2.0)])
    land(tmp_path / "raw", "2.jsonl", [tick("a", 2, 0.5), tick("b", 1, 3.0)])
    rules = lambda: spark.createDataFrame([(1, "a", "price", "above", 4.0, True), (2, "b", "price", "above", 2.5, True)], ALERT_RULE)
    ticks = normalize_types(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
    sink = flows.alert_sink(spark, rules, f"{tmp_path}/history", f"{tmp_path}/latest")
    flows.each_batch(ticks, sink, f"{tmp_path}/cp", interval=None).awaitTermination()
    fired = sorted((r.batch_id, r.id) for r in spark.read.parquet(f"{tmp_path}/history").collect())
    assert fired == [(0, 1), (1, 1), (2, 2)]


def test_ties_across_a_batch_border_are_kept(spark, tmp_path):
    schema = "coin_id string, fetched_at timestamp, price_usd double, volume_24h_usd double, change_24h_pct double"
    row = lambda minute, price: ("a", START + timedelta(minutes=minute), price, 1.0, 1.0)
    sink = flows.indicator_sink(spark, f"{tmp_path}/out", f"{tmp_path}/state")
    sink(spark.createDataFrame([row(0, 1.0), row(1, 2.0)], schema), 0)
    sink(spark.createDataFrame([row(1, 3.0), row(2, 4.0), row(0, 99.0)], schema), 1)
    sink(spark.createDataFrame([], schema), 2)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.price_usd for r in got.collect()) == [1.0, 2.0, 3.0, 4.0]
    assert {r.price_usd: r.open for r in got.collect()} == {1.0: 1.0, 2.0: 1.0, 3.0: 2.0, 4.0: 3.0}


def test_state_is_written_for_touched_keys_and_compacted(spark, tmp_path):
    state = flows.KeyedState(spark, f"{tmp_path}/s", "k", compact=3)
    for i in range(8):
        frame = spark.createDataFrame([(i % 2, i)], "k long, v long")
        state.save(frame, i)
        state.save(frame, i)
        now = {r.k: r.v for r in state.before(i + 1, frame.schema).collect()}
        assert now == {b % 2: b for b in range(max(0, i - 1), i + 1)}
    assert not os.path.exists(f"{tmp_path}/s/batch_id=1") and os.path.exists(f"{tmp_path}/s/batch_id=6")


def drain(spark, tmp_path, stream, name="out"):
    query = flows.append_to(stream, f"{tmp_path}/{name}", f"{tmp_path}/cp-{name}", None)
    query.awaitTermination()
    return query


def arrivals(spark, tmp_path, per_batch=None, lateness="1 hour"):
    raw = flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=per_batch, with_arrival=True)
    return flows.silver_stream(raw, lateness)


def test_the_first_copy_of_a_batch_is_kept(spark, tmp_path):
    """Different copies of a tick in one file, in files of one batch, and in later batches."""
    land(tmp_path / "raw", "0.jsonl", [tick("a", 0, 1.0), tick("a", 1, 2.0), tick("a", 0, 9.0), tick("b", 0, 3.0)])
    land(tmp_path / "raw", "1.jsonl", [tick("a", 1, 8.0), tick("b", 0, 7.0), tick("a", 2, 4.0)])
    drain(spark, tmp_path, arrivals(spark, tmp_path))
    land(tmp_path / "raw", "2.jsonl", [tick("a", 2, 6.0), tick("a", 30, 5.0), tick("a", 0, 6.0)])
    drain(spark, tmp_path, arrivals(spark, tmp_path))
    got = read_layer(spark, f"{tmp_path}/out", SILVER)
    assert sorted((r.coin_id, r.price_usd) for r in got.collect()) == [("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 5.0), ("b", 3.0)]


def test_the_seen_times_go_when_the_watermark_has_passed(spark, tmp_path):
    land(tmp_path / "raw", "0.jsonl", [tick("a", m, 1.0 + m) for m in range(0, 180, 10)])
    drain(spark, tmp_path, arrivals(spark, tmp_path, 1))
    for i, minute in enumerate((400, 500, 600), 1):
        land(tmp_path / "raw", f"{i}.jsonl", [tick("a", minute, 1.0)])
        progress = drain(spark, tmp_path, arrivals(spark, tmp_path, 1)).recentProgress
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    # Three spans of the first file are gone; those that the watermark has not passed stay.
    assert kept[-1] <= 2
    assert read_layer(spark, f"{tmp_path}/out", SILVER).count() == 21


def test_indicators_read_the_keys_of_a_batch_only(spark, tmp_path):
    """10,000 silent keys cost a batch of one key nothing; the state outlives a restart."""
    schema = "coin_id string, fetched_at timestamp, price_usd double, change_24h_pct double"
    folder = tmp_path / "ticks"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(folder))
        query = drain(spark, tmp_path, keyed.indicator_stream(stream))
        return [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]

    add([(f"k{i}", START, float(i), 0.0) for i in range(10_000)])
    run()
    add([("k7", START + timedelta(minutes=m), 100.0 + m % 5, 0.0) for m in range(1, 25)])
    state = run()
    assert state[0]["numRowsTotal"] == 10_000 and sum(s["numRowsUpdated"] for s in state) == 1
    assert sum(s["customMetrics"]["rocksdbGetCount"] for s in state) <= 10
    add([("k7", START + timedelta(minutes=30), 111.0, 0.0), ("k7", START, 5.0, 0.0)])
    run()
    got = spark.read.parquet(f"{tmp_path}/out").where("coin_id = 'k7'")
    assert got.count() == 26  # the late row is dropped
    wanted = indicators(got.select("coin_id", "fetched_at", "price_usd", "change_24h_pct"), SILVER_SERIES)
    names = ["fetched_at", *keyed.PANEL]
    plain = lambda df: sorted([tuple(None if v is None or v != v else round(v, 8) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()])
    assert plain(got) == plain(wanted)


def test_streamed_indicators_equal_the_batch(spark, tmp_path):
    """Nulls in the values, ties across batches, several micro-batches."""
    for i, ticks in enumerate(batches()):
        land(tmp_path / "raw", f"{i}.jsonl", ticks)
    ticks = normalize_types(flows.read_raw_stream(spark, str(tmp_path / "raw"), files_per_batch=1))
    holes = ticks.withColumn("price_usd", F.expr("CASE WHEN minute(fetched_at) % 17 = 3 THEN NULL ELSE price_usd END"))
    drain(spark, tmp_path, keyed.indicator_stream(holes))
    batch = normalize_types(spark.read.schema(RAW_TEXT).json(str(tmp_path / "raw")))
    batch = batch.withColumn("price_usd", F.expr("CASE WHEN minute(fetched_at) % 17 = 3 THEN NULL ELSE price_usd END"))
    names = ["coin_id", "fetched_at", *keyed.PANEL]
    plain = lambda df: sorted(tuple(None if v is None or v != v else round(v, 8) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect())
    assert repr(plain(spark.read.parquet(f"{tmp_path}/out"))) == repr(plain(indicators(batch, SILVER_SERIES)))


def test_updated_windows_are_compacted(spark, tmp_path):
    sink = flows.upsert_windows(f"{tmp_path}/gold", fanout=4)
    schema = GOLD.simpleString()[7:-1].replace(":", " ")
    for i in range(30):
        at = START + timedelta(hours=i // 3)
        sink(spark.createDataFrame([("a", at, at, float(i), 0.0, 0.0, 0.0, 0.0, 0.0, i)], schema).coalesce(1), i)
    got = flows.read_upserts(spark, f"{tmp_path}/gold")
    assert sorted((r.window_start.hour, r.record_count) for r in got.collect()) == [(h, 3 * h + 2) for h in range(10)]
    assert len(flows.window_store(spark, f"{tmp_path}/gold").folders()) <= 4 * 3
