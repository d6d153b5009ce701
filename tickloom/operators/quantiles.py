"""Exact per-key quantiles (linear interpolation) that also work for very large keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.scale import KeyProfile, join_stats, profile
from tickloom.schemas import Series
from tickloom.session import materialize

ACCURACY = 200_000
# distinct values of one key that one aggregation buffer may hold
BUFFER_ROWS = 2_000_000


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], key: str = "coin_id",
    size: KeyProfile | None = None, accuracy: int = ACCURACY, margin: float | None = None, brackets: DataFrame | None = None,
) -> DataFrame:
    """One row per key with the named quantiles of the non-null values.

    ``percentile`` holds every distinct value of a key in one buffer, which is fine until a
    key is hot. Then a sketch brackets each quantile (rank error at most n / accuracy), one
    more pass counts the rows outside the brackets and keeps the values inside, and the
    wanted ranks are read off those counts. Equal values are counted before the shuffle. Keys whose
    rank lies outside its bracket are done again with brackets eight times as wide. ``brackets`` (the
    key, ``_n`` values, ``_edge``: two values around each quantile in ascending order) come from a stored
    sketch and save the first pass.
    """
    size = size or profile(df, Series(key=key))
    names = sorted(probabilities, key=probabilities.get)
    wanted = [probabilities[name] for name in names]
    rows = df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_x"))
    if brackets is None and not size.exceeds(BUFFER_ROWS):
        packed = rows.groupBy(key).agg(F.percentile("_x", wanted).alias("_q"))
        return packed.select(key, *[F.col("_q")[i].alias(name) for i, name in enumerate(names)])

    margin = 2.0 / accuracy if margin is None else margin
    edges = [e for p in wanted for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    if brackets is None:
        brackets = rows.groupBy(key).agg(F.count("_x").alias("_n"), F.percentile_approx("_x", edges, accuracy).alias("_edge"))
    x = F.col("_x")
    zone, inside = F.lit(0), F.lit(False)
    for i in range(len(wanted)):
        low, high = F.col("_edge")[2 * i], F.col("_edge")[2 * i + 1]
        zone = zone + (x >= low).cast("int")
        inside = inside | x.between(low, high)
    # rows outside every bracket only need counting: they follow the brackets already opened
    counts = (
        join_stats(rows, brackets, key, size)
        .groupBy(key, zone.alias("_zone"), F.when(inside, x).alias("_x"))
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"))
    )
    upto = Window.partitionBy(key).orderBy(F.col("_zone"), F.col("_x").asc_nulls_last())
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_end", F.sum("_c").over(upto))
    picks = []
    for name, p in zip(names, wanted):
        at = F.lit(p) * (F.col("_n") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))
            picks.append(F.max(F.when(holds, F.col("_x"))).alias(f"_{side}_{name}"))
    found = materialize(ranked.groupBy(key).agg(F.max("_n").alias("_n"), *picks))
    missed, out = F.lit(False), [F.col(key)]
    for name, p in zip(names, wanted):
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        at = F.lit(p) * (F.col("_n") - 1)
        missed = missed | low.isNull() | high.isNull()
        out.append((low + (at - F.floor(at)) * (high - low)).alias(name))
    again = found.where(missed).select(key)
    if margin >= 1 or again.isEmpty():
        return found.select(*out)
    wider = exact_quantiles(
        df.join(again, key, "left_semi"), value, probabilities, key, size, accuracy, min(1.0, max(8 * margin, 1 / accuracy))
    )
    return found.where(~missed).select(*out).unionByName(wider)
