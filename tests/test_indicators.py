from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tickloom.operators.indicators import bollinger, ohlc, rsi, sma, technical_panel
from tickloom.operators.signals import (
    kpi_latest, period_change, signal_text, signals, technical_cards, technical_summary,
)
from tickloom.schemas import GOLD_SERIES, SERIES

START = datetime(2024, 1, 1)


def series(spark, values, key="a"):
    data = [(key, START + timedelta(minutes=i), None if v is None else float(v), 1.0, 0.5) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "coin_id string, ts timestamp, value double, volume double, change double")


def column(df, name):
    return [r[name] for r in df.orderBy("ts").collect()]


def test_sma_of_one_to_five(spark):
    assert column(sma(series(spark, range(1, 6)), 3), "sma_3") == [None, None, 2.0, 3.0, 4.0]


def test_sma_of_a_short_series_is_null(spark):
    assert column(sma(series(spark, [1, 2]), 5), "sma_5") == [None, None]


def test_sma_needs_a_full_window_of_values(spark):
    assert column(sma(series(spark, [1, None, 3, 4, 5]), 3), "sma_3") == [None, None, None, None, 4.0]


def test_bands_enclose_the_mean_and_collapse_on_a_constant(spark):
    values = np.random.default_rng(1).normal(100, 5, 50)
    for r in bollinger(series(spark, values)).where("bb_middle IS NOT NULL").collect():
        assert r.bb_upper >= r.bb_middle >= r.bb_lower
    flat = bollinger(series(spark, [100.0] * 30)).where("bb_middle IS NOT NULL").collect()
    assert len(flat) == 11 and all(r.bb_upper == r.bb_lower == 100.0 for r in flat)


def test_rsi_matches_rolling_means(spark):
    values = pd.Series(np.random.default_rng(2).normal(100, 3, 100))
    step = values.diff()
    gain, loss = step.clip(lower=0).rolling(14).mean(), (-step).clip(lower=0).rolling(14).mean()
    wanted = 100 - 100 / (1 + gain / loss)
    got = pd.Series(column(rsi(series(spark, values)), "rsi_14"), dtype=float)
    assert got.isna().sum() == 14
    assert np.allclose(got[14:], wanted[14:]) and got[14:].between(0, 100).all()


@pytest.mark.parametrize("values, bound", [([100.0] * 30, 50.0), (list(range(100, 200)), 100.0)])
def test_rsi_without_losses(spark, values, bound):
    assert set(column(rsi(series(spark, values)), "rsi_14")) == {None}
    bounded = column(rsi(series(spark, values), on_zero_loss="bound"), "rsi_14")
    assert set(bounded[14:]) == {bound} and set(bounded[:14]) == {None}


def test_candles_open_at_the_previous_close(spark):
    df = spark.createDataFrame(
        [("a", START + timedelta(minutes=i), p, p + 2, p - 2) for i, p in enumerate([100.0, 105.0, 95.0])],
        "coin_id string, ts timestamp, value double, high double, low double",
    )
    out = ohlc(df).orderBy("ts").collect()
    assert [r.open for r in out] == [100.0, 100.0, 105.0] and [r.close for r in out] == [100.0, 105.0, 95.0]
    assert [r.candle_high for r in out] == [102.0, 107.0, 105.0] and [r.candle_low for r in out] == [98.0, 100.0, 93.0]


def test_candles_without_high_and_low_use_the_value(spark):
    assert column(ohlc(series(spark, [1, 3, 2])), "candle_high") == [1.0, 3.0, 3.0]


def test_panel_needs_five_rows(spark):
    df = series(spark, range(25)).unionByName(series(spark, range(4), "short"))
    out = technical_panel(df)
    assert out.count() == 25 and set(column(out, "volume_direction")) == {"up"}


def signals_of(spark, values):
    return signals(series(spark, values)).first()


def test_rising_series(spark):
    r = signals_of(spark, [100 + 2 * i for i in range(30)])
    # no loss in the window: RSI is null, which the signal calls neutral and the zone oversold
    assert r.rsi is None and r.rsi_signal == "Neutral"
    assert (r.bb_signal, r.ma_signal, r.total_score, r.recommendation) == ("Neutral", "Bullish (Uptrend)", 1, "Buy")
    assert technical_summary(series(spark, [100 + 2 * i for i in range(30)])).first().rsi_zone == "Oversold"


def test_cards_keep_keys_with_a_null_rsi(spark):
    card = technical_cards(series(spark, [100 + 2 * i for i in range(30)])).first()
    assert card.rsi is None and card.rsi_zone == "Oversold" and card.recommendation == "Buy"
    assert card.period_change_pct == pytest.approx(58.0) and card.bb_width > 0


def test_falling_series(spark):
    r = signals_of(spark, [200 - 2 * i for i in range(30)])
    assert (r.rsi, r.rsi_signal) == (0.0, "Bullish (Oversold)")
    assert (r.bb_signal, r.ma_signal, r.recommendation) == ("Neutral", "Bearish (Downtrend)", "Neutral")


def test_narrow_bands_take_the_first_branch(spark):
    assert signals_of(spark, [100.0] * 30).bb_signal == "Bearish (Overextended)"


def test_short_histories(spark):
    r = signals_of(spark, [1, 2, 1, 2, 1, 2])
    assert (r.rsi, r.bb_signal, r.ma_signal) == (50.0, "Neutral (No Data)", "Neutral (No Data)")
    fourteen = signals_of(spark, [1, 2] * 7)  # passes the row gate, but RSI needs fifteen rows
    assert fourteen.rsi is None
    assert signals(series(spark, [1, 2, 3, 4])).count() == 0


def test_texts_quote_the_numbers(spark):
    r = signal_text(signals(series(spark, [200 - 2 * i for i in range(30)]))).first()
    assert r.rsi_text.startswith("RSI is at 0.0, indicating the asset is oversold")
    assert r.bb_text == "Price ($142.0000) is stable within the bands, trading near the middle line ($161.0000)."
    assert "SMA(10) ($151.0000) and SMA(20) ($161.0000)" in r.ma_text


def test_kpi_and_period_change(spark):
    df = series(spark, [10, 20, 30]).unionByName(series(spark, [5], "one")).unionByName(series(spark, [0, 4], "zero"))
    kpi = {r.coin_id: (r.last_value, r.previous_value, r.change_pct) for r in kpi_latest(df).collect()}
    assert kpi == {"a": (30.0, 20.0, 50.0), "zero": (4.0, 0.0, 0.0)}
    change = {r.coin_id: r.change_pct for r in period_change(df).collect()}
    assert change == {"a": 200.0, "one": 0.0, "zero": None}


def test_gold_columns_work_under_their_own_names(spark):
    df = series(spark, range(1, 26)).toDF("coin_id", "window_start", "avg_price", "avg_volume", "avg_change_pct")
    assert technical_panel(df, GOLD_SERIES).count() == 25
    assert SERIES.but(tiebreak=("x",)).order == ("ts", "x")
