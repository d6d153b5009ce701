from datetime import datetime

from pyspark.sql import functions as F

from tickloom.operators.aggregate import resample, to_gold
from tickloom.operators.clean import (
    canonical_series, dedup_first, drop_unusable, flag_quality, normalize_types, prepare_series,
    to_silver, unknown_keys,
)
from tickloom.schemas import GOLD, SILVER

RAW = "coin_id string, price_usd string, market_cap_usd string, volume_24h_usd string, change_24h_pct string, last_updated string, fetched_at string"


def raw(spark, *ticks):
    return spark.createDataFrame(list(ticks), RAW)


def tick(coin="bitcoin", price="50000", change="1.0", at="2024-01-01T09:30:00+00:00", volume="3e10", updated="1700000000"):
    return (coin, price, "1e12", volume, change, updated, at)


def test_types_are_coerced_and_bad_values_become_null(spark):
    df = normalize_types(raw(spark, tick(), tick(price="n/a", at="yesterday", updated="x"), tick(price="NaN")))
    good, nan, bad = sorted(df.collect(), key=lambda r: (r.fetched_at is None, r.price_usd is None))
    assert good.price_usd == 50000.0 and good.volume_24h_usd == 3e10
    assert good.fetched_at is not None and good.last_updated is not None
    assert nan.price_usd is None
    assert bad.price_usd is None and bad.fetched_at is None and bad.last_updated is None


def test_missing_columns_are_added_and_extra_ones_kept(spark):
    df = normalize_types(spark.createDataFrame([("a", "x")], "coin_id string, note string"))
    row = df.first()
    assert row.note == "x" and row.price_usd is None and row.fetched_at is None


def test_epoch_seconds_are_utc(spark):
    df = normalize_types(raw(spark, tick(updated="0.5")))
    assert df.select(F.unix_micros("last_updated")).first()[0] == 500_000


def test_silver_drops_null_keys_null_prices_and_nonpositive_prices(spark):
    df = raw(spark, tick(), tick(coin=None), tick(price=None), tick(price="-1"), tick(price="0"))
    silver = to_silver(normalize_types(df), ["price_usd"])
    assert silver.count() == 1


def test_nan_price_is_not_positive(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0)], "coin_id string, price_usd double")
    assert drop_unusable(df).count() == 1


def test_quality_flag_bounds_are_inclusive_and_null_is_suspicious(spark):
    df = spark.createDataFrame([(5.0,), (9999.0,), (-100.0,), (1000.0,), (-100.1,), (None,)], "change_24h_pct double")
    flags = {r[0]: r[1] for r in flag_quality(df).collect()}
    assert flags == {5.0: "good", 9999.0: "suspicious", -100.0: "good", 1000.0: "good", -100.1: "suspicious", None: "suspicious"}


def test_without_a_change_column_everything_is_good(spark):
    assert flag_quality(spark.range(2)).where("data_quality_flag = 'good'").count() == 2


def test_first_arrival_wins_and_null_times_of_a_key_are_one_group(spark):
    df = spark.createDataFrame(
        [("a", None, 3), ("a", None, 1), ("a", 5, 2), ("a", 5, 4), ("b", None, 9)], "coin_id string, t int, seq int"
    )
    assert sorted(r.seq for r in dedup_first(df, ["coin_id", "t"], ["seq"]).collect()) == [1, 2, 9]


def test_gold_of_two_ticks_in_one_window(spark):
    df = raw(spark, tick(), tick(price="50100", change="1.5", volume="3.1e10", at="2024-01-01T09:30:05+00:00"))
    row = to_gold(to_silver(normalize_types(df), ["price_usd"])).first()
    assert (row.avg_price, row.min_price, row.max_price, row.record_count) == (50050.0, 50000.0, 50100.0, 2)
    assert (row.avg_volume, row.avg_change_pct) == (3.05e10, 1.25)
    assert abs(row.price_volatility - 70.710678) < 1e-6
    assert row.window_end - row.window_start == datetime(1, 1, 1, 0, 0, 10) - datetime(1, 1, 1)


def test_gold_of_one_tick_has_zero_volatility_and_null_groups_vanish(spark):
    df = raw(spark, tick(), tick(coin=None), tick(at=None))
    gold = to_gold(normalize_types(df))
    assert gold.count() == 1 and gold.first().price_volatility == 0.0


def test_empty_input_stays_empty_with_a_schema(spark):
    silver = to_silver(spark.createDataFrame([], "coin_id string, price_usd double, change_24h_pct double, volume_24h_usd double, fetched_at timestamp"), ["price_usd"])
    gold = to_gold(silver)
    assert gold.count() == 0 and gold.columns == GOLD.fieldNames()


def test_gold_without_times_is_returned_unchanged(spark):
    df = spark.createDataFrame([("a", 1.0)], "coin_id string, price_usd double")
    assert to_gold(df) is df


def gold_rows(spark, *values):
    data = [("a", datetime(2024, 1, 1, 0, m), datetime(2024, 1, 1, 0, m, 10), p, p - 1, p + 1, 10.0, 1.0, 0.5, 2) for m, p in values]
    return spark.createDataFrame(data, GOLD)


def test_resample_takes_min_max_sum_and_mean(spark):
    bins = resample(gold_rows(spark, (0, 10.0), (1, 20.0), (6, 40.0)), "5m").orderBy("window_start").collect()
    assert [(b.avg_price, b.min_price, b.max_price, b.avg_volume, b.record_count) for b in bins] == [
        (15.0, 9.0, 21.0, 20.0, 4), (40.0, 39.0, 41.0, 10.0, 2)
    ]
    assert "window_end" not in bins[0]


def test_resampled_volume_of_nulls_is_zero(spark):
    gold = gold_rows(spark, (0, 10.0)).withColumn("avg_volume", F.lit(None).cast("double"))
    assert resample(gold, "5m").first().avg_volume == 0.0


def test_resample_to_one_minute_or_unknown_changes_nothing(spark):
    gold = gold_rows(spark, (0, 10.0))
    assert resample(gold, "1m") is gold and resample(gold, "2d") is gold


def test_bins_without_an_average_are_dropped(spark):
    assert resample(gold_rows(spark, (0, 10.0)).withColumn("avg_price", F.lit(None).cast("double")), "5m").count() == 0


def test_prepare_series_drops_rows_without_time_or_value(spark):
    df = spark.createDataFrame([("a", "2024-01-01", "1.5", "x"), ("a", "?", "1", "1"), ("a", "2024-01-01", "?", "1")],
                               "coin_id string, t string, v string, extra string")
    out = prepare_series(df, "t", "v", ["extra", "absent"]).collect()
    assert len(out) == 1 and out[0].v == 1.5 and out[0].extra is None


def test_layer_choice_falls_back_to_silver(spark):
    silver = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0, None, datetime(2024, 1, 1), "good")], SILVER)
    empty = spark.createDataFrame([], GOLD)
    assert canonical_series(empty, silver).first().value == 1.0
    assert canonical_series(gold_rows(spark, (0, 7.0)), silver).first().value == 7.0


def test_unknown_keys_are_trimmed_and_reported(spark):
    asked = spark.createDataFrame([(" bitcoin ",), ("foo",), ("",)], "coin_id string")
    known = spark.createDataFrame([("bitcoin",)], "coin_id string")
    assert [r[0] for r in unknown_keys(asked, known).collect()] == ["foo"]
