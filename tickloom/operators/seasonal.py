"""Seasonal additive forecast: piecewise-linear trend, daily and weekly cycles, volume.

The model family is that of Taylor & Letham, "Forecasting at Scale" (2018): Gaussian priors on level,
slope, cycles and volume, a Laplace prior on the trend changes, so that most of them are exactly zero.
The normal equations are sums over rows, so a long history is cut into chunks whose 42 x 42 partial
sums are added up; memory per key does not depend on its length. The most probable weights follow from
those sums alone: the Gaussian part is eliminated, the changes are found by a search over their signs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import micros
from tickloom.operators.forecast import STEPS, outlook, with_linear
from tickloom.scale import KeyProfile, join_stats, profile, with_ordinal
from tickloom.schemas import GOLD_SERIES, Series
from tickloom.session import materialize

CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
DAY = 86_400_000_000
CYCLES = ((DAY, 4), (7 * DAY, 3))  # period in microseconds, Fourier order
CHUNK_ROWS = 200_000
# Prior standard deviations of level and slope, cycles and regressor; scale of the trend changes' Laplace prior.
PRIOR_BASE, PRIOR_CYCLE, PRIOR_VOLUME, CHANGE_SCALE = 5.0, 10.0, 10.0, 0.05
CHANGES = slice(2, 2 + CHANGEPOINTS)
#: Search steps; some tens are needed.
STEPS_AT_MOST = 1_000


def _design(at: np.ndarray, volume: np.ndarray, p: pd.Series) -> np.ndarray:
    """Feature matrix: level, slope, hinges, sine/cosine pairs, standardised volume."""
    t = (at - p["t0"]) / p["span"]
    knots = (np.asarray(p["knots"], dtype="float64") - p["t0"]) / p["span"]
    hinges = np.zeros((len(t), CHANGEPOINTS))
    hinges[:, : len(knots)] = np.maximum(t[:, None] - knots[None, :], 0.0)
    waves = []
    for period, order in CYCLES:
        phase = 2 * np.pi * (at % period) / period
        for k in range(1, order + 1):
            waves += [np.sin(k * phase), np.cos(k * phase)]
    regressor = (volume - p["vol_mean"]) / p["vol_sd"]
    return np.column_stack([np.ones_like(t), t, hinges, *waves, regressor])


def _prior() -> np.ndarray:
    """Standard deviations of the Gaussian priors; infinite where the prior is another one."""
    cycles = 2 * sum(order for _, order in CYCLES)
    return np.array([PRIOR_BASE] * 2 + [np.inf] * CHANGEPOINTS + [PRIOR_CYCLE] * cycles + [PRIOR_VOLUME])


def _sums(rows: pd.DataFrame, p: pd.Series) -> np.ndarray:
    """Upper-left X'X, border X'y and corner y'y as one square matrix."""
    total = 0.0
    for start in range(0, len(rows), 50_000):
        part = rows.iloc[start : start + 50_000]
        x = _design(part["at"].to_numpy(), part["volume"].to_numpy(), p)
        full = np.column_stack([x, part["value"].to_numpy() / p["scale"]])
        total = total + full.T @ full
    return total


def sparse_changes(gram: np.ndarray, cross: np.ndarray, penalty: float) -> np.ndarray:
    """The w that makes w'Gw / 2 - c'w + penalty * sum |w| least, by feature-sign search.

    With the signs of w given, the least value is a linear system. A search step goes towards its
    solution, no further than the best of the points where a sign changes; a zero weight joins when the
    slope there exceeds the penalty. Each step lowers the value, so no set of signs comes twice.
    """
    w, on = np.zeros(len(cross)), np.zeros(len(cross), bool)
    signs, slack = np.zeros(len(cross)), penalty * 1e-9 + 1e-12 * np.abs(cross).max(initial=0.0)

    def value(v: np.ndarray) -> float:
        return v @ gram @ v / 2 - cross @ v + penalty * np.abs(v).sum()

    for _ in range(STEPS_AT_MOST):
        slope = gram @ w - cross
        settled = np.abs(slope + penalty * signs)[on].max(initial=0.0) <= slack * 1e3
        if settled:
            over = np.where(on, 0.0, np.abs(slope))
            j = int(over.argmax())
            if over[j] <= penalty + slack:
                return w
            on[j], signs[j] = True, -np.sign(slope[j])
        some = np.flatnonzero(on)
        goal = np.linalg.lstsq(gram[np.ix_(some, some)], cross[some] - penalty * signs[some], rcond=None)[0]
        step = goal - w[some]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossings = -w[some] / step
        best, least = w, np.inf if settled else value(w)
        for share in [1.0, *sorted(crossings[(crossings > 0) & (crossings < 1)])]:
            trial = w.copy()
            trial[some] = w[some] + share * step
            trial[some[np.isclose(crossings, share, rtol=0, atol=1e-15)]] = 0.0
            if value(trial) < least:
                best, least = trial, value(trial)
        if best is w:
            return w
        w = best
        on = w != 0
        signs = np.sign(w)
    return w


def _solve(sums: np.ndarray, n: int) -> np.ndarray:
    """Most probable weights; the noise level comes from a nearly unpenalised first fit."""
    gram, cross, energy = sums[:-1, :-1], sums[:-1, -1], sums[-1, -1]
    weak = np.linalg.lstsq(gram + 1e-9 * n * np.eye(len(gram)), cross, rcond=None)[0]
    noise = max((energy - 2 * weak @ cross + weak @ gram @ weak) / n, 1e-12)
    full = gram + noise * np.diag(_prior() ** -2.0)
    change = np.zeros(len(gram), bool)
    change[CHANGES] = True
    # Whatever the changes are, the other weights follow from them.
    own, both, rest = full[np.ix_(~change, ~change)], full[np.ix_(~change, change)], cross[~change]
    back = np.linalg.solve(own, np.column_stack([both, rest]))
    weights = np.zeros(len(gram))
    weights[change] = sparse_changes(full[np.ix_(change, change)] - both.T @ back[:, :-1], cross[change] - both.T @ back[:, -1], noise / CHANGE_SCALE)
    weights[~change] = back[:, -1] - back[:, :-1] @ weights[change]
    return weights


def _predict(weights: np.ndarray, p: pd.Series, steps: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(1, steps + 1)
    at = (p["last_micros"] + step * p["step_micros"]).astype("float64")
    return step, _design(at, np.full(steps, p["last_volume"]), p) @ weights * p["scale"]


def _parameters(rows: DataFrame, by: Series, size: KeyProfile) -> DataFrame:
    """One row per key: scaling, changepoint times, and the number of chunks of its history."""
    order = F.struct("at", *by.tiebreak)
    stats = rows.groupBy(by.key).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").cast("double").alias("t0"),
        F.greatest(F.max("at") - F.min("at"), F.lit(1)).cast("double").alias("span"),
        F.max(F.abs("value")).alias("_scale"), F.avg("volume").alias("vol_mean"),
        F.stddev_samp("volume").alias("_sd"), F.max_by("volume", order).alias("last_volume"),
    ).withColumns({
        "scale": F.when(F.col("_scale") > 0, F.col("_scale")).otherwise(1.0),
        "vol_sd": F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0),
        "chunks": F.ceil(F.col("n") / CHUNK_ROWS),
    }).drop("_scale", "_sd")
    early = F.floor(F.col("n") * CHANGEPOINT_RANGE)
    count = F.least(F.lit(CHANGEPOINTS), early - 1)
    wanted = F.transform(
        F.sequence(F.lit(1), count.cast("int")), lambda j: F.rint(j * (early - 1) / count).cast("bigint")
    )
    marks = stats.select(by.key, wanted.alias("_wanted"))
    placed = with_ordinal(rows.select(by.key, *by.tiebreak, "at", "_t"), by.but(ts="_t"), size, "_i")
    knots = (
        join_stats(placed, marks, by.key, size).where(F.array_contains("_wanted", F.col("_i")))
        .groupBy(by.key).agg(F.sort_array(F.collect_list(F.col("at").cast("double"))).alias("knots"))
    )
    return stats.join(knots, by.key).select(by.key, *[c for c in stats.columns if c != by.key], "knots")


def forecast_seasonal(
    df: DataFrame, steps: int = STEPS, by: Series = GOLD_SERIES, size: KeyProfile | None = None
) -> DataFrame:
    """Trend with changepoints + daily and weekly cycles + volume, continued ``steps`` steps.

    The future volume stays at its last value. Rows without a value are left out. Keys with fewer
    than ten values, or with a value that has no volume, get the linear forecast.
    """
    size = size or profile(df, by)
    ahead = outlook(df, by, size, whole=True)
    enough = ahead.where("_modelled").select(by.key)
    rows = join_stats(df, enough, by.key, size, "left_semi").where(
        F.col(by.value).isNotNull() & F.col(by.volume).isNotNull()
    ).select(
        by.key, *by.tiebreak, F.col(by.ts).cast("timestamp").alias("_t"), micros(by.ts).alias("at"),
        F.col(by.value).alias("value"), F.col(by.volume).alias("volume"),
    )
    # a row per key that several steps use: computed once, cut off from its lineage
    parameters = materialize(_parameters(rows, by, size).join(ahead.select(by.key, "last_micros", "step_micros"), by.key))
    cells = rows.select(by.key, F.col("at").cast("double").alias("at"), "value", "volume")
    key_type = dict(df.dtypes)[by.key]
    model = _fit(cells, _fresh(parameters), by.key, key_type, steps, size).withColumn("method", F.lit("seasonal"))
    return with_linear(model, df, steps, by, size, ahead)


def _fresh(df: DataFrame) -> DataFrame:
    """New column identities, for a cogroup of two tables with the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _fit(cells, parameters, key, key_type, steps, size):
    """Partial sums per chunk of a history, added up cell by cell, then one small solve."""

    def per_chunk(rows: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or params.empty:
            return pd.DataFrame({key: [], "cells": []})
        p = params.iloc[0]
        return pd.DataFrame({key: [p[key]], "cells": [_sums(rows, p).ravel()]})

    def per_key(sums: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if sums.empty or params.empty:
            return pd.DataFrame({key: [], "step": [], "predicted_price": []})
        p = params.iloc[0]
        values = sums.sort_values("pos")["total"].to_numpy()
        width = int(round(len(values) ** 0.5))
        weights = _solve(values.reshape(width, width), int(p["n"]))
        step, price = _predict(weights, p, steps)
        return pd.DataFrame({key: p[key], "step": step, "predicted_price": price})

    chunked = join_stats(cells, parameters.select(key, "chunks"), key, size).withColumn(
        "_chunk", F.pmod(F.xxhash64("at", "value"), F.col("chunks"))
    ).drop("chunks")
    spread = _fresh(parameters).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    partial = chunked.groupBy(key, "_chunk").cogroup(spread.groupBy(key, "_chunk")).applyInPandas(
        per_chunk, f"{key} {key_type}, cells array<double>"
    )
    total = (
        partial.select(key, F.posexplode("cells").alias("pos", "cell"))
        .groupBy(key, "pos").agg(F.sum("cell").alias("total"))
    )
    return total.groupBy(key).cogroup(parameters.groupBy(key)).applyInPandas(
        per_key, f"{key} {key_type}, step int, predicted_price double"
    )
