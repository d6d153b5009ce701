from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tickloom.operators.forecast import (
    actual_plus_forecast, ar_fit, forecast, forecast_ar, forecast_linear, forecast_summary,
)
from tickloom.operators.seasonal import forecast_seasonal
from tickloom.schemas import GOLD_SERIES

START = datetime(2024, 1, 1)
SCHEMA = "coin_id string, window_start timestamp, avg_price double, avg_volume double"


def gold(spark, prices, key="a", volumes=None, step=timedelta(minutes=1)):
    volumes = [1e9 + i for i in range(len(prices))] if volumes is None else volumes
    return spark.createDataFrame(
        [(key, START + i * step, None if p is None else float(p), None if v is None else float(v))
         for i, (p, v) in enumerate(zip(prices, volumes))], SCHEMA)


@pytest.mark.parametrize("model", ["ar", "seasonal", "linear", "arima", "prophet"])
@pytest.mark.parametrize("n", [30, 5, 1])
def test_every_model_gives_twelve_steps(spark, model, n):
    out = forecast(gold(spark, [50000 + 10 * i for i in range(n)]), model).orderBy("step").collect()
    assert [r.step for r in out] == list(range(1, 13))
    assert out[0].window_start == START + timedelta(minutes=n) and out[11].window_start == START + timedelta(minutes=n + 11)
    assert all(r.predicted_price is not None for r in out)
    if n == 1:
        assert {r.predicted_price for r in out} == {50000.0}


@pytest.mark.parametrize("model", ["ar", "seasonal", "linear"])
def test_empty_history_gives_nothing(spark, model):
    assert forecast(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_linear_continues_a_line_and_skips_null_prices(spark):
    out = forecast_linear(gold(spark, [1, None, 2, 3])).orderBy("step").collect()
    assert [r.predicted_price for r in out[:2]] == pytest.approx([4.0, 5.0])
    assert out[0].window_start == START + timedelta(minutes=4)


def test_key_without_prices_is_left_out(spark):
    df = gold(spark, [1, 2]).unionByName(gold(spark, [None, None], "empty"))
    assert {r.coin_id for r in forecast_ar(df).collect()} == {"a"}


def test_missing_volumes_fall_back_to_the_line(spark):
    out = forecast_ar(gold(spark, range(20), volumes=[None] * 20)).collect()
    assert {r.method for r in out} == {"linear"} and out[0].predicted_price == pytest.approx(19 + out[0].step)


def test_a_pure_trend_in_volume_is_flat_ahead(spark):
    # the residual is zero and the future volume stays, so the last value stays
    out = forecast_ar(gold(spark, [3.0 * v for v in range(1, 31)], volumes=range(1, 31))).collect()
    assert all(r.predicted_price == pytest.approx(90.0) for r in out)


def test_planted_autoregression_is_recovered(spark):
    rng = np.random.default_rng(5)
    phi, n = np.array([0.4, -0.2, 0.1, 0.05, -0.1]), 40_000
    step = np.zeros(n)
    noise = rng.normal(size=n)
    for t in range(n):
        step[t] = sum(phi[k] * step[t - 1 - k] for k in range(5) if t > k) + noise[t]
    volume = np.cumsum(rng.normal(size=n))
    df = gold(spark, 2.5 * volume + np.cumsum(step), volumes=volume, step=timedelta(seconds=1))
    fit = ar_fit(df).first()
    assert fit.beta == pytest.approx(2.5, abs=0.02)
    assert fit.a == pytest.approx(list(phi), abs=0.02)


def test_planted_trend_and_daily_cycle_are_continued(spark):
    rng = np.random.default_rng(6)
    n = 24 * 28

    def truth(h):
        return 100 + 0.05 * h + 5 * np.sin(2 * np.pi * h / 24)

    prices = [truth(h) + rng.normal(0, 0.2) for h in range(n)]
    df = gold(spark, prices, volumes=rng.uniform(1, 2, n), step=timedelta(hours=1))
    for r in forecast_seasonal(df).collect():
        assert r.method == "seasonal" and r.predicted_price == pytest.approx(truth(n - 1 + r.step), abs=0.6)


def test_summary_and_stacked_series(spark):
    df = gold(spark, [1, 2, 3, 4])
    ahead = forecast_linear(df)
    r = forecast_summary(ahead, df).first()
    assert (r.last_actual, r.last_forecast, r.change_pct) == (4.0, pytest.approx(16.0), pytest.approx(300.0))
    kinds = actual_plus_forecast(ahead, df).groupBy("kind").count().collect()
    assert {k["kind"]: k["count"] for k in kinds} == {"actual": 4, "forecast": 12}
    assert GOLD_SERIES.value == "avg_price"


def test_a_missing_volume_makes_the_seasonal_forecast_linear(spark):
    """Hourly prices near 100 with a volume only in the first rows stay near 100."""
    from datetime import datetime, timedelta

    from tickloom.operators.seasonal import forecast_seasonal
    from tickloom.schemas import GOLD_SERIES

    start = datetime(2024, 1, 1)
    data = [(k, start + timedelta(hours=i), 100.0 + i % 3, 5.0 + i if i < 8 or k == "b" else None) for k in "ab" for i in range(60)]
    frame = spark.createDataFrame(data, "coin_id string, window_start timestamp, avg_price double, avg_volume double")
    got = forecast_seasonal(frame, by=GOLD_SERIES).collect()
    assert {(r.coin_id, r.method) for r in got} == {("a", "linear"), ("b", "seasonal")} and len(got) == 24
    assert all(95 < r.predicted_price < 105 for r in got if r.coin_id == "a")


def planted_trend(n, changes, noise, seed=0):
    """Hourly values of a trend with slope changes at some shares of the first 80 %, and a daily wave."""
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    value = 100 + 0.02 * i
    for share, slope in changes:
        value = value + slope * np.maximum(i - share * 0.8 * n, 0)
    return value + 3 * np.sin(2 * np.pi * i / 24) + noise * rng.standard_normal(n)


def test_only_the_planted_changes_are_not_zero():
    from tickloom.operators import seasonal

    n = 2000
    values = planted_trend(n, [(10 / 25, 0.08), (20 / 25, -0.12)], 2.0)
    at = np.arange(n) * 3.6e9 + 1.7e15
    early = np.floor(n * 0.8)
    p = pd.Series({
        "t0": at[0], "span": at[-1] - at[0], "scale": np.abs(values).max(), "vol_mean": 0.0, "vol_sd": 1.0,
        "knots": at[np.rint(np.arange(1, 26) * (early - 1) / 25).astype(int)],
    })
    sums = seasonal._sums(pd.DataFrame({"at": at, "value": values, "volume": np.zeros(n)}), p)
    weights = seasonal._solve(sums, n)
    changes = weights[seasonal.CHANGES]
    large = set(np.flatnonzero(np.abs(changes) > 0.1 * np.abs(changes).max()).tolist())
    assert {9, 19} <= large <= {8, 9, 10, 18, 19, 20}
    assert (changes == 0).sum() >= 15


@pytest.mark.parametrize("seed", range(4))
def test_sparse_changes_equal_a_plain_descent(seed):
    """Proximal gradient steps, an independent way to the same least value."""
    from tickloom.operators.seasonal import sparse_changes

    rng = np.random.default_rng(seed)
    x = np.cumsum(rng.standard_normal((300, 12)), axis=0) / 20
    gram, cross, penalty = x.T @ x, x.T @ rng.standard_normal(300), 3.0
    w, step = np.zeros(12), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(200_000):
        v = w - step * (gram @ w - cross)
        w = np.sign(v) * np.maximum(np.abs(v) - step * penalty, 0)
    got = sparse_changes(gram, cross, penalty)
    cost = lambda u: u @ gram @ u / 2 - cross @ u + penalty * np.abs(u).sum()
    assert cost(got) <= cost(w) + 1e-6
    left = gram @ got - cross
    assert (np.abs(left) <= penalty + 1e-5).all() and np.allclose(left[got != 0], -penalty * np.sign(got[got != 0]), atol=1e-4)
    assert (sparse_changes(gram, cross, 1e9) == 0).all()


def test_the_joint_fit_finds_beta_under_autocorrelated_volume(spark):
    """Volume steps and residual steps that hang on their past: whitening makes beta sharper."""
    rng = np.random.default_rng(11)
    n, runs, errors = 400, 12, {0: [], 3: []}
    frames = []
    for run in range(runs):
        du, dx = np.zeros(n), np.zeros(n)
        for t in range(n):
            du[t] = (0.85 * du[t - 1] if t else 0) + rng.standard_normal()
            dx[t] = (0.6 * dx[t - 1] if t else 0) + rng.standard_normal()
        frames += [(f"k{run}", START + timedelta(minutes=t), float(p), float(x)) for t, (p, x) in
                   enumerate(zip(100 + np.cumsum(2.5 * dx + du), np.cumsum(dx)))]
    frame = spark.createDataFrame(frames, SCHEMA).cache()
    for rounds in errors:
        fit = ar_fit(frame, GOLD_SERIES, rounds=rounds).collect()
        errors[rounds] = [abs(r.beta - 2.5) for r in fit]
        assert all(abs(r.a[0] - 0.85) < 0.25 for r in fit)
    assert np.mean(errors[3]) < 0.8 * np.mean(errors[0]) and max(errors[3]) < 0.2
