"""The plans for very long keys give exactly the results of the plain ones."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators.aggregate import distribution, sampling_interval
from tickloom.operators.compare import correlation_matrix, normalized, returns
from tickloom.operators.filters import min_history
from tickloom.operators.forecast import forecast_ar, forecast_linear
from tickloom.operators.indicators import indicators
from tickloom.operators.quantiles import exact_quantiles
from tickloom.operators.seasonal import forecast_seasonal
from tickloom.scale import BLOCK, assign_blocks, profile, with_ordinal
from tickloom.schemas import SERIES

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def bursty(spark):
    """One key with most rows, gaps of months, and a burst inside one hour; some small keys."""
    rng = np.random.default_rng(7)
    data = []
    at = [START + timedelta(days=float(d)) for d in rng.uniform(0, 200, 300)]
    at += [START + timedelta(days=50, seconds=float(s)) for s in rng.uniform(0, 3600, 500)]
    at += [START + timedelta(days=400 + 30 * i) for i in range(8)]
    price = 100 + np.cumsum(rng.normal(0, 1, len(at)))
    data += [("hot", t, float(p), float(v)) for t, p, v in zip(sorted(at), price, rng.uniform(1, 9, len(at)))]
    for key, n in (("b", 60), ("c", 12), ("d", 3)):
        for i in range(n):
            data.append((key, START + timedelta(minutes=7 * i), float(50 + rng.normal()), float(rng.uniform(1, 9))))
    df = spark.createDataFrame(data, "coin_id string, ts timestamp, value double, volume double")
    return df.withColumn("change", F.lit(0.5)).cache()


def sizes(df, limit):
    plain, hot = profile(df), profile(df, block_rows=limit)
    assert not plain.hot and hot.hot
    return plain, hot


def test_profile_counts(spark, bursty):
    size = profile(bursty)
    assert (size.keys, size.rows, size.max_rows) == (4, 883, 808)


def test_block_size_grows_with_the_table_so_that_hot_lists_stay_small(spark):
    from tickloom.scale import KeyProfile, MAX_SMALL_ROWS

    rows = 10**13
    limit = max(1_000_000, -(-rows // MAX_SMALL_ROWS))
    assert rows / KeyProfile(5, rows, rows // 3, limit).block_rows <= MAX_SMALL_ROWS


def test_blocks_follow_time_and_split_bursts(spark, bursty):
    blocked = assign_blocks(bursty, SERIES, profile(bursty, block_rows=40))
    spans = blocked.where("coin_id = 'hot'").groupBy(BLOCK).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    ordered = spans.orderBy(BLOCK).collect()
    assert len(ordered) > 15 and all(x.b < y.a for x, y in zip(ordered, ordered[1:]))
    assert max(r.n for r in ordered) <= 60
    assert blocked.where("coin_id <> 'hot' AND coin_id <> 'b'").select(BLOCK).distinct().count() == 1


@pytest.mark.parametrize("limit", [1, 5, 40, 300])
def test_indicators(spark, bursty, rows, limit):
    plain, hot = sizes(bursty, limit)
    assert rows(indicators(bursty, size=hot), 7) == rows(indicators(bursty, size=plain), 7)


@pytest.mark.parametrize("limit", [5, 100])
def test_row_operators(spark, bursty, rows, limit):
    plain, hot = sizes(bursty, limit)
    for op in (with_ordinal, returns, normalized, sampling_interval, forecast_linear, forecast_ar):
        assert rows(op(bursty, by=SERIES, size=hot), 6) == rows(op(bursty, by=SERIES, size=plain), 6), op.__name__
    assert rows(min_history(bursty, 20, size=hot)) == rows(min_history(bursty, 20, size=plain))


def test_quantiles(spark, bursty, rows):
    plain, hot = sizes(bursty, 5)
    assert rows(distribution(bursty, "value", size=hot)) == rows(distribution(bursty, "value", size=plain))


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_bracketed_quantiles_with_repeated_values(spark, accuracy):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(1500, 4.0), rng.normal(5, 3, 3000), rng.integers(0, 9, 500).astype(float)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None), ("b", 1.0)], "coin_id string, x double")
    probs = {"low": 0.01, "q1": 0.25, "median": 0.5, "top": 0.999}
    got = {r.coin_id: r for r in exact_quantiles(df, "x", probs, size=profile(df, block_rows=10), accuracy=accuracy).collect()}
    for name, p in probs.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p)) and got["b"][name] == 1.0


def test_correlation_paths_agree(spark, bursty, rows, monkeypatch):
    from tickloom.operators import compare

    plain, hot = sizes(bursty, 40)
    wide = rows(correlation_matrix(bursty, size=plain, method="wide"), 7)
    assert len(wide) == 16
    assert rows(correlation_matrix(bursty, size=hot, method="wide"), 7) == wide
    monkeypatch.setattr(compare, "KEYS_PER_BLOCK", 2)
    monkeypatch.setattr(compare, "CELLS_PER_TASK", 100)
    monkeypatch.setattr(compare, "DENSE_CELLS", 7)
    assert rows(correlation_matrix(bursty, size=plain, method="chunked"), 7) == wide


def test_correlation_matches_pandas(spark, bursty):
    wide = bursty.toPandas().sort_values("ts")
    table = wide.pivot_table(index=wide.groupby("coin_id").cumcount(), columns="coin_id", values="value").corr()
    for r in correlation_matrix(bursty).collect():
        assert r.correlation == pytest.approx(table.loc[r.coin_a, r.coin_b])


def test_correlation_of_a_constant_is_null_and_one_key_gives_nothing(spark):
    df = spark.createDataFrame(
        [(k, START + timedelta(minutes=i), v) for i in range(4) for k, v in (("a", 1.0), ("b", float(i)))],
        "coin_id string, ts timestamp, value double",
    )
    out = {(r.coin_a, r.coin_b): r.correlation for r in correlation_matrix(df).collect()}
    assert out == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): pytest.approx(1.0)}
    assert correlation_matrix(df, ["a"]).count() == 0


def test_seasonal_chunks(spark, bursty, rows, monkeypatch):
    from tickloom.operators import seasonal

    plain, hot = sizes(bursty, 40)
    whole = rows(forecast_seasonal(bursty, by=SERIES, size=plain), 4)
    monkeypatch.setattr(seasonal, "CHUNK_ROWS", 50)
    assert rows(forecast_seasonal(bursty, by=SERIES, size=hot), 4) == whole
    assert len(whole) == 4 * 12


def test_more_keys_than_the_pivot_takes_are_all_compared(spark, rows):
    from datetime import datetime, timedelta

    from tickloom.operators.compare import correlation_matrix

    start = datetime(2024, 1, 1)
    data = [(f"k{k:02}", start + timedelta(minutes=i), float((i * (k + 3)) % 17 + i % (k + 2))) for k in range(12) for i in range(60)]
    frame = spark.createDataFrame(data, "coin_id string, ts timestamp, value double")
    wide = rows(correlation_matrix(frame, method="wide"), 9)
    assert len(wide) == 144 and wide == rows(correlation_matrix(frame, method="chunked"), 9)
    assert all(a != b or c == 1.0 for a, b, c in wide)
    few = frame.where("coin_id < 'k05'")
    assert rows(correlation_matrix(few, method="wide"), 9) == rows(correlation_matrix(few, method="chunked"), 9)


def test_a_quantile_outside_its_bracket_is_looked_up_again(spark):
    values = [float((i * 7919) % 10007) for i in range(4000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "coin_id string, x double")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.77}
    got = {r.coin_id: r for r in exact_quantiles(df, "x", probs, size=profile(df, block_rows=10), accuracy=5, margin=0.0).collect()}
    for name, p in probs.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p)) and got["b"][name] == 1.0
