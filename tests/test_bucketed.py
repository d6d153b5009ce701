import uuid
from datetime import datetime, timedelta

from tickloom.operators.aggregate import to_gold
from tickloom.operators.clean import dedup_first, to_silver
from tickloom.operators.indicators import indicators, sma
from tickloom.scale import profile
from tickloom.schemas import SILVER_SERIES
from tickloom.sources.bucketed import buckets_for, open_bucketed, write_bucketed

START = datetime(2024, 1, 1)


def ticks(spark):
    rows = [(f"k{i % 9}", START + timedelta(seconds=40 * (i // 9) * (1 + i % 2)), 100.0 + i % 13, 1.0, 2.0, i) for i in range(1800)]
    return spark.createDataFrame(rows, "coin_id string, fetched_at timestamp, price_usd double, volume_24h_usd double, change_24h_pct double, seq long")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_operators_over_buckets_need_no_shuffle(spark, tmp_path, rows):
    name, frame = f"t{uuid.uuid4().hex}", ticks(spark).repartition(6)
    stored = write_bucketed(frame, name, f"{tmp_path}/b", 4)
    again = open_bucketed(spark, f"{name}_again", f"{tmp_path}/b", frame.schema, 4)
    try:
        by = SILVER_SERIES.but(tiebreak=("seq",))
        for table in (stored, again):
            size = profile(table, by)
            for build in (
                lambda t: sma(t, 20, by, size if t is table else None),
                lambda t: indicators(t, by, size if t is table else None),
                lambda t: to_gold(t, "7 minutes"),
                lambda t: dedup_first(t, ["coin_id", "fetched_at"], ["seq"]),
                lambda t: to_gold(to_silver(t, ["seq"]), "1 hour"),
            ):
                got = build(table)
                assert "Exchange" not in plan(got)
                assert rows(got, 7) == rows(build(frame).select(*got.columns), 7)
        assert "Exchange" in plan(to_gold(frame, "7 minutes"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_again")


def test_hot_keys_still_go_to_blocks(spark, tmp_path, rows):
    name = f"t{uuid.uuid4().hex}"
    stored = write_bucketed(ticks(spark), name, f"{tmp_path}/b", 4)
    by = SILVER_SERIES.but(tiebreak=("seq",))
    spark.conf.set("tickloom.block.rows", "50")
    try:
        blocked = sma(stored, 20, by)
        assert "Exchange" in plan(blocked)
        got = rows(blocked, 7)
    finally:
        spark.conf.unset("tickloom.block.rows")
    assert got == rows(sma(stored, 20, by).select(*blocked.columns), 7)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_follow_the_bytes():
    assert buckets_for(0) == 8 and buckets_for(100 << 40) == 1 << 19 and buckets_for(9 * (256 << 20)) == 16
