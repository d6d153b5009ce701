from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.operators.filters import trailing_range
from tickloom.schemas import SILVER
from tickloom.sources import pruned
from tickloom.sources.layers import write_layer

START = datetime(2024, 1, 1)


def stored(spark, path):
    rows = [("a", float(i), START + timedelta(hours=i)) for i in range(24 * 5)] + [("b", 1.0, None)]
    write_layer(spark.createDataFrame(rows, "coin_id string, price_usd double, fetched_at timestamp"), path, "fetched_at")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_answers_without_reading_all_dates(spark, tmp_path, rows):
    path = f"{tmp_path}/silver"
    stored(spark, path)
    whole = spark.read.parquet(path)
    assert [str(r.dt) for r in pruned.layer_dates(spark, path).orderBy("dt").collect()] == [f"2024-01-0{i}" for i in range(1, 6)]
    fresh = pruned.layer_freshness(spark, path, SILVER, "fetched_at")
    assert rows(fresh) == [(START, START + timedelta(hours=119))] and "dt" in plan(fresh).split("PartitionFilters: [")[1][:60]
    assert pruned.count_rows(spark, path) == 121
    assert rows(pruned.layer_sizes(spark, {"x": path, "none": f"{tmp_path}/none"})) == [("none", 0, 0), ("x", 121, 5)]
    for label, start in (("6h", None), ("30m", None), ("all", None), (None, None), ("odd", None), ("session", START + timedelta(hours=100)),
                         ("session", START + timedelta(days=90)), ("session", datetime(2024, 1, 3, tzinfo=timezone.utc))):
        got = pruned.layer_trailing_range(spark, path, SILVER, label, "fetched_at", start).select("coin_id", "fetched_at")
        want = trailing_range(whole, label, "fetched_at", start).select("coin_id", "fetched_at")
        assert rows(got) == rows(want)
    got = pruned.layer_trailing_range(spark, path, SILVER, "6h", "fetched_at")
    assert "PartitionFilters: [isnotnull(dt" in plan(got)
    assert got.select(F.input_file_name()).distinct().count() <= 2


def test_counts_come_from_the_footers(spark, tmp_path):
    path = f"{tmp_path}/silver"
    stored(spark, path)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    assert "PushedAggregation: [COUNT(*)]" in plan(own.read.parquet(path).agg(F.count(F.lit(1))))


def test_missing_layers(spark, tmp_path):
    path = f"{tmp_path}/none"
    assert pruned.layer_freshness(spark, path, SILVER, "fetched_at").collect()[0].last_ts is None
    assert pruned.layer_trailing_range(spark, path, SILVER, "6h", "fetched_at").count() == 0
