import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.plans.catalog import _slices
from tickloom.plans.fixtures import Fixtures
from tickloom.plans.medallion import read_gold, run_cycle
from tickloom.schemas import ALERT_RULE, GOLD, SILVER
from tickloom.sources.layers import (
    apply_retention, expired_files, json_records, list_sessions, load_session, read_json_table, read_layer, retain,
    save_session, write_json_table, write_layer,
)
from tickloom.sources.raw import flatten_snapshot, read_raw, write_raw


def line(coin, price, at="2024-01-01T09:30:00+00:00"):
    return json.dumps({"coin_id": coin, "price_usd": price, "fetched_at": at, "volume_24h_usd": 5, "change_24h_pct": 1})


def land(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_a_file_with_a_broken_line_is_skipped_whole(spark, tmp_path):
    land(tmp_path, "a.jsonl", line("a", 1), line("b", "oops"))
    land(tmp_path, "b.jsonl", line("c", 1), '{"coin_id": "d", "pri')
    land(tmp_path, "ignored.txt", line("z", 1))
    assert sorted(r.coin_id for r in read_raw(spark, str(tmp_path)).collect()) == ["a", "b"]
    assert sorted(r.coin_id for r in read_raw(spark, str(tmp_path), on_corrupt="record").collect()) == ["a", "b", "c"]


def test_missing_or_empty_folder_is_an_empty_frame(spark, tmp_path):
    assert read_raw(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "empty").mkdir()
    assert read_layer(spark, f"{tmp_path}/none", GOLD).columns == GOLD.fieldNames()
    assert read_layer(spark, f"{tmp_path}/empty", GOLD).count() == 0


def test_writing_nothing_makes_no_file(spark, tmp_path):
    write_raw(spark.createDataFrame([], "a string"), f"{tmp_path}/raw")
    assert not os.path.exists(f"{tmp_path}/raw")


def test_snapshot_is_flattened_by_currency(spark):
    payload = json.dumps({"bitcoin": {"eur": 5.0, "eur_24h_vol": 7.0, "last_updated_at": 1.7e9}, "solana": {"usd": 1.0}})
    df = spark.createDataFrame([(payload, "2024-01-01T00:00:00+00:00")], "payload string, fetched_at string")
    out = {r.coin_id: r for r in flatten_snapshot(df, "eur").collect()}
    assert out["bitcoin"].price_usd == 5.0 and out["bitcoin"].volume_24h_usd == 7.0
    assert out["bitcoin"].market_cap_usd is None and out["solana"].price_usd is None


def test_cycle_writes_all_layers_and_a_repeat_changes_nothing(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    assert not run_cycle(spark, str(raw), str(tmp_path))
    land(raw, "1.jsonl", line("a", 100), line("a", 101, "2024-01-01T09:30:05+00:00"), line(None, 5), line("a", -1, "2024-01-01T09:31:00+00:00"))
    land(raw, "2.jsonl", line("a", 999), line("b", "n/a"))
    for _ in range(2):
        assert run_cycle(spark, str(raw), str(tmp_path))
        bronze = spark.read.parquet(f"{tmp_path}/bronze")
        silver = read_layer(spark, f"{tmp_path}/silver", SILVER)
        gold = read_gold(spark, str(tmp_path)).collect()
        assert bronze.count() == 6
        # 999 is a later copy of the first tick: the first file wins
        assert sorted(r.price_usd for r in silver.collect()) == [100.0, 101.0]
        assert len(gold) == 1 and gold[0].avg_price == 100.5 and gold[0].record_count == 2


def gold_rows(spark, n):
    start = datetime(2024, 1, 1)
    data = [("a", start + timedelta(seconds=10 * i), start + timedelta(seconds=10 * i + 10), float(i), 0.0, 0.0, 0.0, 0.0, 0.0, 1) for i in range(n)]
    return spark.createDataFrame(data, GOLD)


def test_sessions(spark, tmp_path):
    path = f"{tmp_path}/sessions"
    assert list_sessions(spark, path).count() == 0
    empty = spark.createDataFrame([], GOLD)
    save_session(gold_rows(spark, 600), empty, path, datetime(2024, 1, 1))
    save_session(empty, gold_rows(spark, 3), path, datetime(2024, 1, 2))
    assert [r.session for r in list_sessions(spark, path).collect()] == ["session_20240102_000000", "session_20240101_000000"]
    newest = load_session(spark, path, "session_20240101_000000", GOLD).collect()
    assert len(newest) == 500 and newest[0].avg_price == 599.0
    assert load_session(spark, path, "session_20240102_000000", GOLD).count() == 3
    assert load_session(spark, path, "other", GOLD).count() == 0


def test_date_pruning(spark, tmp_path):
    write_layer(gold_rows(spark, 9000), f"{tmp_path}/gold", "window_start")
    recent = read_layer(spark, f"{tmp_path}/gold", GOLD, since=datetime(2024, 1, 2))
    assert recent.count() == 9000 - 8640
    assert "PartitionFilters: [isnotnull(dt" in recent._jdf.queryExecution().executedPlan().toString()


def test_retention(spark, tmp_path):
    now = datetime(2024, 1, 1, 1, 0, 0, tzinfo=timezone.utc)
    assert retain(gold_rows(spark, 360), "window_start", 0.5, now).count() == 180
    land(tmp_path, "old.jsonl", line("a", 1))
    land(tmp_path, "new.jsonl", line("a", 1))
    os.utime(tmp_path / "old.jsonl", (1, 1))
    assert [os.path.basename(r.path) for r in expired_files(spark, str(tmp_path)).collect()] == ["old.jsonl"]


def test_rule_table_round_trip(spark, tmp_path):
    path = f"{tmp_path}/store/alerts"
    assert read_json_table(spark, path, ALERT_RULE).count() == 0
    rules = spark.createDataFrame([(1, "bitcoin", "price", "above", 10.0, True)], ALERT_RULE)
    write_json_table(rules, path)
    assert read_json_table(spark, path, ALERT_RULE).collect() == rules.collect()
    more = spark.createDataFrame([(i, f"coin{i}", "price", "below", 1.0, i % 2 == 0) for i in range(2, 7)], ALERT_RULE)
    write_json_table(more.coalesce(1), path)
    assert sorted(read_json_table(spark, path, ALERT_RULE).collect()) == sorted(more.collect())
    (tmp_path / "array.json").write_text('[{"id": 1, "coin": "a", "active": true}, {"id": 2, "coin": "b"}]')
    assert read_json_table(spark, f"{tmp_path}/array.json", ALERT_RULE, array=True).count() == 2
    (tmp_path / "bad.json").write_text("not json")
    assert read_json_table(spark, f"{tmp_path}/bad.json", ALERT_RULE).count() == 0


def test_json_records_have_iso_times(spark):
    record = json.loads(json_records(gold_rows(spark, 1)).first().record)
    assert record["window_start"] == "2024-01-01T00:00:00.000Z" and record["record_count"] == 1


def test_a_batch_without_a_column_leaves_the_others_alone(spark, tmp_path):
    full = spark.createDataFrame([("a", datetime(2024, 1, 1), 7.0)], "coin_id string, fetched_at timestamp, price_usd double")
    for i, frame in enumerate((full.drop("price_usd"), full, full.drop("price_usd"))):
        write_layer(frame, f"{tmp_path}/silver", "fetched_at", i)
    got = read_layer(spark, f"{tmp_path}/silver", SILVER, more=["batch_id"])
    assert sorted((r.batch_id, r.price_usd) for r in got.collect()) == [(0, None), (1, 7.0), (2, None)]


def test_the_first_written_batch_wins(spark, tmp_path):
    for price in (1.0, 2.0, 3.0):
        write_raw(spark.createDataFrame([("a", str(price), "2024-01-01T00:00:00+00:00")], "coin_id string, price_usd string, fetched_at string"), f"{tmp_path}/raw")
    assert run_cycle(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    assert [r.price_usd for r in read_layer(spark, f"{tmp_path}/out/silver", SILVER).collect()] == [1.0]


def test_cycles_take_new_files_and_replace_touched_windows(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    raw.mkdir()
    files = [
        [line("a", 100), line("b", 1)],
        [line("a", 102, "2024-01-01T09:30:01+00:00"), line("a", 555), line("c", 1, None)],
        [line("a", 9, "2024-01-02T00:00:00+00:00"), line("b", 3, "2024-01-01T09:30:02+00:00"), line("c", 2, None)],
    ]
    for i, lines in enumerate(files):
        land(raw, f"{i}.jsonl", *lines)
        assert run_cycle(spark, str(raw), f"{tmp_path}/steps", i)
        assert not run_cycle(spark, str(raw), f"{tmp_path}/steps", i + 1)
    assert run_cycle(spark, str(raw), f"{tmp_path}/once")
    for read in (lambda x: read_layer(spark, f"{tmp_path}/{x}/silver", SILVER), lambda x: read_gold(spark, f"{tmp_path}/{x}")):
        assert rows(read("steps")) == rows(read("once")) and read("steps").count() > 0
    assert run_cycle(spark, str(raw), f"{tmp_path}/steps", 2)
    assert read_layer(spark, f"{tmp_path}/steps/silver", SILVER).count() == 6


def test_a_partly_written_file_is_taken_once_it_is_whole(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    land(raw, "0.jsonl", line("a", 1), '{"coin_id": "d", "pri')
    land(raw, "1.jsonl", line("b", 1))
    assert run_cycle(spark, str(raw), f"{tmp_path}/out", 0)
    land(raw, "0.jsonl", line("a", 1), line("d", 1))
    assert run_cycle(spark, str(raw), f"{tmp_path}/out", 1)
    assert sorted(r.coin_id for r in read_layer(spark, f"{tmp_path}/out/silver", SILVER).collect()) == ["a", "b", "d"]


def test_retention_deletes_or_archives(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name in ("old.jsonl", "older.jsonl", "new.jsonl"):
        land(raw, name, line("a", 1))
    os.utime(raw / "old.jsonl", (10_000, 10_000))
    os.utime(raw / "older.jsonl", (1, 1))
    cut = datetime.fromtimestamp(5_000 + 3600, timezone.utc)
    assert apply_retention(spark, str(raw), 1, cut, archive=f"{tmp_path}/kept") == 1
    assert os.listdir(tmp_path / "kept")[0] == "older.jsonl" and not os.path.exists(raw / "older.jsonl")
    assert apply_retention(spark, str(raw), 1) == 1
    assert [f for f in os.listdir(raw) if f.endswith("jsonl") and f[0] != "."] == ["new.jsonl"]


def counting(spark):
    """A filter that keeps every row, and how many rows it has seen."""
    seen = spark.sparkContext.accumulator(0)

    def keep(_):
        seen.add(1)
        return True

    return F.udf(keep, "boolean"), seen


def test_a_batch_is_computed_once(spark, tmp_path):
    keep, seen = counting(spark)
    records = spark.range(100).select(F.col("id").cast("string").alias("coin_id")).where(keep("coin_id")).repartitionByRange(2, "coin_id")
    write_raw(records, f"{tmp_path}/raw")
    assert seen.value <= 200  # a look at the keys, and the write
    assert os.listdir(tmp_path) == ["raw"] and read_raw(spark, f"{tmp_path}/raw").count() == 100


def test_slices_take_one_pass_and_hold_every_row_once(spark, tmp_path):
    start = datetime(2024, 1, 1)
    events = [(i, None if i == 7 else start + timedelta(hours=i), "a", 10.0 + i, '{"k": 1}') for i in range(80)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    keep, seen = counting(spark)
    f = Fixtures(spark, str(tmp_path))
    text = f.raw_text()
    parts = _slices(f, text.where(keep("seq")), 4)
    for part in parts:
        write_raw(part, f"{tmp_path}/raw")
    assert seen.value == text.count()
    got = [[r.asDict() for r in part.collect()] for part in parts]
    assert all(got) and all([r["seq"] for r in part] == sorted(r["seq"] for r in part) for part in got)
    assert sorted((r for part in got for r in part), key=str) == sorted((r.asDict() for r in text.collect()), key=str)
    assert all(r["fetched_at"] is not None for part in got[1:] for r in part)
    assert max(r["fetched_at"] or "" for r in got[0]) < min(r["fetched_at"] for r in got[1])


def test_records_are_not_shuffled_to_leave_out_broken_files(spark, tmp_path):
    land(tmp_path, "0.jsonl", line("a", 1), '{"coin_id": "d", "pri')
    land(tmp_path, "1.jsonl", line("b", 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large folders
    try:
        read = read_raw(spark, str(tmp_path))
        assert [r.coin_id for r in read.collect()] == ["b"]
        assert "SortMergeJoin" not in read._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
