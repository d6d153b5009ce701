"""Per-key forecasts: linear trend and an autoregressive model with a volume regressor.

Each forecast is a long table (key, step, window_start, predicted_price, method).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import percent_change
from tickloom.operators.aggregate import horizon, latest_of
from tickloom.scale import KeyProfile, join_stats, ordered, over_rows, profile, with_ordinal
from tickloom.schemas import GOLD_SERIES, Series
from tickloom.session import materialize

STEPS = 12
MIN_MODEL_ROWS, MIN_ALIGNED_ROWS = 10, 5
AR_ORDER = 5
# residual energy below this share of the step energy counts as a perfect fit
NOISE_FLOOR = 1e-12
#: Joint rounds of the regression and the autoregression.
GLS_ROUNDS = 3


def outlook(df: DataFrame, by: Series, size: KeyProfile, whole: bool = False) -> DataFrame:
    """One row per key: its last time, its step, and whether it has enough history for a model.

    One pass, written once: the choice of the method, the short keys and the times of the steps
    all read it.
    """
    return materialize(horizon(df, by, size, has_history(by, whole)))


def stamp(predicted: DataFrame, ahead: DataFrame, by: Series, size: KeyProfile) -> DataFrame:
    """Give (key, step, predicted_price, method) rows the time of their step."""
    at = F.timestamp_micros(F.col("last_micros") + F.col("step") * F.col("step_micros"))
    return join_stats(predicted, ahead.select(by.key, "last_micros", "step_micros"), by.key, size).select(
        by.key, "step", at.alias("window_start"), "predicted_price", "method"
    )


def _linear_steps(df: DataFrame, steps: int, by: Series, size: KeyProfile) -> DataFrame:
    known = df.where(F.col(by.value).isNotNull()).select(by.key, *by.order, by.value)
    placed = with_ordinal(known, by, size, "_i")
    y, x = F.col(by.value), F.col("_i").cast("double")
    fitted = placed.groupBy(by.key).agg(
        F.count(y).alias("_n"),
        F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("_slope"),
        F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("_intercept"),
    )
    line = F.col("_intercept") + F.col("_slope") * (F.col("_n") - 1 + F.col("step"))
    return fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select(
        by.key, "step", line.alias("predicted_price"), F.lit("linear").alias("method")
    )


def forecast_linear(
    df: DataFrame, steps: int = STEPS, by: Series = GOLD_SERIES, size: KeyProfile | None = None
) -> DataFrame:
    """Least squares over the row position, continued; a single row stays constant."""
    size = size or profile(df, by)
    return stamp(_linear_steps(df, steps, by, size), horizon(df, by, size), by, size)


def has_history(by: Series, whole: bool = False) -> list[Column]:
    """Aggregates of a key's rows: ``_modelled`` (enough for a model) and ``_any`` value.

    With ``whole`` every value must have a volume, as a regression on it asks for.
    """
    value, aligned = F.col(by.value), F.when(F.col(by.volume).isNotNull(), F.col(by.value))
    least = F.count(value) if whole else F.lit(MIN_ALIGNED_ROWS)
    enough = (F.count(value) >= MIN_MODEL_ROWS) & (F.count(aligned) >= least)
    return [enough.alias("_modelled"), (F.count(value) > 0).alias("_any")]


def linear_for_short(df: DataFrame, steps: int, by: Series, size: KeyProfile, ahead: DataFrame) -> DataFrame | None:
    """Linear steps of the keys whose history is too short for a model; None if there is no such key."""
    short = ahead.where("_any AND NOT _modelled").select(by.key)
    if short.isEmpty():
        return None
    return _linear_steps(join_stats(df, short, by.key, size, "left_semi"), steps, by, size)


def with_linear(model: DataFrame, df: DataFrame, steps: int, by: Series, size: KeyProfile, ahead: DataFrame) -> DataFrame:
    """A model's steps, those of the keys too short for it, and the times of all."""
    short = linear_for_short(df, steps, by, size, ahead)
    return stamp(model if short is None else model.unionByName(short), ahead, by, size)


def _step_sums(df: DataFrame, by: Series, size: KeyProfile) -> DataFrame:
    """Per key: the products of value and volume steps at lags 0..5, and the newest steps.

    The step covariances of the regression residual are quadratic in the regression
    coefficient, so these sums are all the fit needs: one pass over the rows.
    """
    y, x = by.value, by.volume

    def lagged(rows: DataFrame, part: list[str]) -> DataFrame:
        w = ordered(part, by)
        before = {f"_{c}{k}": F.lag(c, k).over(w) for c in (y, x) for k in range(1, AR_ORDER + 2)}
        rows = rows.withColumns(before).withColumns({f"_{c}0": F.col(c) for c in (y, x)})
        return rows.withColumns({
            f"_d{name}{k}": F.col(f"_{c}{k}") - F.col(f"_{c}{k + 1}")
            for name, c in (("y", y), ("x", x)) for k in range(AR_ORDER + 1)
        })

    aligned = df.where(F.col(y).isNotNull() & F.col(x).isNotNull()).select(by.key, *by.order, y, x)
    rows = over_rows(aligned, lagged, AR_ORDER + 1, by, size)
    sums = [
        F.coalesce(F.sum(F.col(f"_d{a}0") * F.col(f"_d{b}{k}")), F.lit(0.0)).alias(f"{a}{b}{k}")
        for k in range(AR_ORDER + 1) for a in "xy" for b in "xy"
    ]
    recent = F.struct(
        F.col(y).alias("y"),
        *[F.coalesce(F.col(f"_d{a}{k}"), F.lit(0.0)).alias(f"d{a}{k}") for a in "xy" for k in range(AR_ORDER)],
    )
    newest = F.max_by(recent, F.struct(*by.order)).alias("_last")
    return rows.groupBy(by.key).agg(newest, *sums)


def _levinson(r: Column) -> Column:
    """Autoregressive coefficients [a1..a5] from autocovariances [r0..r5] (Levinson-Durbin)."""

    def extend(state: Column, m: Column) -> Column:
        a, e = state["a"], state["e"]
        products = F.zip_with(a, F.reverse(F.slice(r, 2, m - 1)), lambda x, y: x * y)
        explained = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
        k = F.coalesce(F.try_divide(F.element_at(r, m + 1) - explained, e), F.lit(0.0))
        updated = F.zip_with(a, F.reverse(a), lambda x, y: x - k * y)
        return F.struct(F.concat(updated, F.array(k)).alias("a"), (e * (1 - k * k)).alias("e"))

    start = F.struct(F.array().cast("array<double>").alias("a"), r[0].alias("e"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(AR_ORDER)), start, extend)["a"]


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _fit_again(state: Column, lags: dict[str, Column], floor: Column) -> Column:
    """beta and the autoregressive coefficients in turn, both from the lag sums.

    Given the coefficients, beta is least squares on steps that the autoregression has whitened; given
    beta, the coefficients solve the Yule-Walker equations of the residual steps.
    """
    places = F.sequence(F.lit(0), F.lit(AR_ORDER))

    def whitened(forth: Column, back: Column) -> Column:
        """The sum of products of two whitened steps, from the sums of products k steps apart."""
        def row(total: Column, i: Column) -> Column:
            def cell(part: Column, j: Column) -> Column:
                apart = F.when(j >= i, F.get(forth, j - i)).otherwise(F.get(back, i - j))
                return part + F.get(state["filter"], i) * F.get(state["filter"], j) * apart

            return total + F.aggregate(places, F.lit(0.0), cell)

        return F.aggregate(places, F.lit(0.0), row)

    beta = F.coalesce(F.try_divide(whitened(lags["xy"], lags["yx"]), whitened(lags["xx"], lags["xx"])), state["beta"])
    return _bound(beta, lambda b: _with_coefficients(b, lags, floor))


def _with_coefficients(beta: Column, lags: dict[str, Column], floor: Column) -> Column:
    """The state (beta, a, filter) that follows from beta."""
    covariances = F.array(*[
        lags["yy"][k] - beta * (lags["xy"][k] + lags["yx"][k]) + beta * beta * lags["xx"][k] for k in range(AR_ORDER + 1)
    ])
    perfect = F.array(*[F.lit(0.0)] * (AR_ORDER + 1))
    a = _bound(covariances, lambda r: _bound(F.when(r[0] <= floor, perfect).otherwise(r), _levinson))
    return _bound(a, lambda c: F.struct(
        beta.alias("beta"), c.alias("a"), F.concat(F.array(F.lit(1.0)), F.transform(c, lambda v: -v)).alias("filter")))


def ar_fit(df: DataFrame, by: Series = GOLD_SERIES, size: KeyProfile | None = None, rounds: int = GLS_ROUNDS) -> DataFrame:
    """One row per key: ``beta``, coefficients ``a``, newest value ``y``, newest residual steps ``d``.

    beta starts as least squares on the steps; ``rounds`` times it is fitted again on whitened steps
    (generalised least squares), and the coefficients after it. No further pass over the rows.
    """
    size = size or profile(df, by)
    sums = _step_sums(df, by, size)
    fit = sums.select(by.key, "_last", (F.col("yy0") * NOISE_FLOOR).alias("_floor"), *[
        F.array(*[f"{pair}{k}" for k in range(AR_ORDER + 1)]).alias(f"_{pair}") for pair in ("xx", "xy", "yx", "yy")
    ])
    lags, floor = {pair: F.col(f"_{pair}") for pair in ("xx", "xy", "yx", "yy")}, F.col("_floor")
    first = F.coalesce(F.try_divide(F.col("_xy")[0], F.col("_xx")[0]), F.lit(0.0))
    start = _bound(first, lambda b: _with_coefficients(b, lags, floor))
    fit = fit.withColumn("_fit", F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda state, _: _fit_again(state, lags, floor)) if rounds else start)
    b = F.col("_fit.beta")
    recent = F.array(*[F.col(f"_last.dy{k}") - b * F.col(f"_last.dx{k}") for k in range(AR_ORDER)])
    return fit.select(by.key, b.alias("beta"), F.col("_last.y").alias("y"), recent.alias("d"), F.col("_fit.a").alias("a"))


def _continue(steps: int) -> Column:
    """The next ``steps`` levels of the process from ``y``, ``d`` and ``a``."""

    def move(state: Column, _: Column) -> Column:
        terms = F.zip_with(F.col("a"), state["past"], lambda x, y: x * y)
        step = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
        level = F.element_at(state["path"], -1) + step
        past = F.concat(F.array(step), F.slice(state["past"], 1, AR_ORDER - 1))
        return F.struct(past.alias("past"), F.concat(state["path"], F.array(level)).alias("path"))

    start = F.struct(F.col("d").alias("past"), F.array("y").alias("path"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, move)["path"]
    return F.slice(path, 2, steps)


def forecast_ar(
    df: DataFrame, steps: int = STEPS, by: Series = GOLD_SERIES, size: KeyProfile | None = None
) -> DataFrame:
    """value = beta * volume + u, where the steps of u follow an AR(5) process.

    beta and the coefficients are fitted in turn, by generalised least squares and the Yule-Walker
    equations, and the future volume stays at its last value. This estimator is not the exact maximum
    likelihood of a state-space fit; it is consistent, always stationary, and needs only sums.
    Keys with fewer than ten values, or five with a volume, get the linear forecast.
    """
    size = size or profile(df, by)
    ahead = outlook(df, by, size)
    fit = join_stats(ar_fit(df, by, size), ahead.where("_modelled").select(by.key), by.key, size, "left_semi")
    model = fit.select(by.key, F.posexplode(_continue(steps)).alias("_p", "predicted_price")).select(
        by.key, (F.col("_p") + 1).alias("step"), "predicted_price", F.lit("ar").alias("method")
    )
    return with_linear(model, df, steps, by, size, ahead)


def forecast(
    df: DataFrame, model: str = "ar", steps: int = STEPS, by: Series = GOLD_SERIES,
    size: KeyProfile | None = None,
) -> DataFrame:
    """Forecast with the named model: "seasonal" ("prophet"), "linear", anything else is "ar"."""
    from tickloom.operators.seasonal import forecast_seasonal

    chosen = {"seasonal": forecast_seasonal, "prophet": forecast_seasonal, "linear": forecast_linear}
    return chosen.get(model, forecast_ar)(df, steps, by, size)


def forecast_summary(forecasts: DataFrame, history: DataFrame, by: Series = GOLD_SERIES) -> DataFrame:
    """Per key: last actual value, last forecast, and the change between them in percent."""
    final = forecasts.groupBy(by.key).agg(F.max_by("predicted_price", "step").alias("last_forecast"))
    actual = history.groupBy(by.key).agg(latest_of(by.value, by).alias("last_actual"))
    return actual.join(final, by.key).select(
        by.key, "last_actual", "last_forecast",
        percent_change("last_forecast", "last_actual").alias("change_pct"),
    )


def actual_plus_forecast(forecasts: DataFrame, history: DataFrame, by: Series = GOLD_SERIES) -> DataFrame:
    """History and forecast stacked: (key, window_start, price, kind)."""
    actual = history.select(
        by.key, F.col(by.ts).cast("timestamp").alias("window_start"), F.col(by.value).alias("price"),
        F.lit("actual").alias("kind"),
    )
    ahead = forecasts.select(
        by.key, "window_start", F.col("predicted_price").alias("price"), F.lit("forecast").alias("kind")
    )
    return actual.unionByName(ahead)
