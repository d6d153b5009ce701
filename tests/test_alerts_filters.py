from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.functions.columns import direction, seconds_of, shift_minutes, shorten_number
from tickloom.operators.alerts import add_rule, check_alerts, recent_history, remove_rules, suggested_threshold
from tickloom.operators.aggregate import layer_counts, sampling_interval, status_by_key, volume_total
from tickloom.operators.filters import explore_counts, select_keys, trailing_range
from tickloom.schemas import ALERT_RULE

START = datetime(2024, 1, 1)
RULES = [
    (1, "a", "price", "above", 10.0, True), (2, "a", "price", "below", 10.0, True),
    (3, "a", "price", "above", 12.0, True), (4, "a", "change_24h", "above", 5.0, True),
    (5, "a", "other", "above", 0.0, True), (6, "a", "price", "above", 1.0, False),
    (7, "gone", "price", "above", 1.0, True), (8, "a", "price", "above", 1.0, None),
]


def series(spark):
    data = [("a", START, 5.0, 1.0, 1.0), ("a", START + timedelta(hours=2), 12.0, 2.0, 6.0),
            ("b", START + timedelta(hours=1), 7.0, None, None)]
    return spark.createDataFrame(data, "coin_id string, ts timestamp, value double, volume double, change double")


def test_only_active_rules_that_hold_strictly_fire(spark):
    rules = spark.createDataFrame(RULES, ALERT_RULE)
    fired = {r.id: r for r in check_alerts(series(spark), rules, checked_at=datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)).collect()}
    assert set(fired) == {1, 4}
    assert (fired[1].time, fired[1].coin, fired[1].type, fired[1].message) == ("03:04:05", "A", "price", "A above 10.0")


def test_rules_are_added_and_removed(spark):
    rules = spark.createDataFrame(RULES[:2], ALERT_RULE)
    more = add_rule(rules, "b", "price", "below", None, datetime(2024, 1, 1, tzinfo=timezone.utc))
    new = more.where("coin = 'b'").first()
    assert (new.id, new.threshold, new.active) == (1704067200000, 0.0, True)
    assert add_rule(rules, "b", "price", "", 1) is rules
    left = remove_rules(more, spark.createDataFrame([(1,)], "id long"))
    assert sorted(r.id for r in left.collect()) == [2, 1704067200000]


def test_suggested_thresholds(spark):
    keys = spark.createDataFrame([("a",), ("none",)], "coin_id string")
    out = {r.coin_id: (r.price_threshold, r.change_threshold) for r in suggested_threshold(keys, series(spark)).collect()}
    assert out == {"a": (13.2, 5.0), "none": (0.0, 5.0)}


def test_history_is_newest_first(spark):
    assert [r.id for r in recent_history(spark.range(60), "id").collect()] == list(range(59, 9, -1))


def test_key_selection(spark):
    df = series(spark)
    assert select_keys(df, []).count() == 3 and select_keys(df, [], empty_means="none").count() == 0
    assert select_keys(df, ["b"]).count() == 1
    assert select_keys(df, spark.createDataFrame([("a",)], "coin_id string")).count() == 2


def test_range_labels():
    assert [seconds_of(x) for x in ("30m", "1h", "24h", "soon")] == [1800, 3600, 86400, None]


def test_cutoff_is_global_and_inclusive(spark):
    df = series(spark)
    assert sorted(r.value for r in trailing_range(df, "1h").collect()) == [7.0, 12.0]
    for unfiltered in ("all", None, "soon"):
        assert trailing_range(df, unfiltered).count() == 3


def test_session_range_and_its_fallback(spark):
    df = series(spark)
    start = datetime(2024, 1, 1, 1, tzinfo=timezone.utc)
    assert trailing_range(df, "session", session_start=start).count() == 2
    assert trailing_range(df, "session", session_start=start.replace(year=2030)).count() == 1


def test_cutoff_reaches_the_scan(spark, tmp_path):
    series(spark).write.parquet(f"{tmp_path}/s")
    plan = trailing_range(spark.read.parquet(f"{tmp_path}/s"), "1h")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan or "ts#" in plan.split("DataFilters")[1].split("]")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_offset_moves_the_shown_time(spark):
    shifted = series(spark).select(shift_minutes("ts", 60).alias("t")).orderBy("t").first().t
    assert shifted == START - timedelta(hours=1)


def test_counts(spark):
    df = series(spark)
    r = explore_counts(df, ["a"], limit=1).first()
    assert (r.shown_rows, r.total_rows) == (1, 2)
    c = layer_counts(df.limit(0), df).first()
    assert (c.gold_rows, c.silver_rows, c["keys"], c.layer) == (0, 3, 2, "Silver")
    status = {r.coin_id: (r.records, r.latest, r.volume) for r in status_by_key(df).collect()}
    assert status == {"a": (2, 12.0, 3.0), "b": (1, 7.0, 0.0)}
    assert [r.coin_id for r in volume_total(df).collect()] == ["a"]


def test_sampling_interval_of_one_row_is_a_minute(spark):
    out = {r.coin_id: r.step_micros for r in sampling_interval(series(spark)).collect()}
    assert out == {"a": 7_200_000_000, "b": 60_000_000}


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,)], "c double")
    rows = df.select("c", direction("c").alias("d"), direction("c", "up").alias("v")).collect()
    assert [(r.d, r.v) for r in rows] == [("up", "up"), ("down", "down"), ("down", "up")]
    texts = spark.createDataFrame([(60.0,), (12345678.5,), (0.25,), (None,)], "c double").select(shorten_number("c").alias("t"))
    assert [r.t for r in texts.collect()] == ["60.0", "12345678.5", "0.25", None]
    assert spark.range(1).select(F.lit(1)).count() == 1
