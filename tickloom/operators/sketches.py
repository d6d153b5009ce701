"""Quantiles over stored sketches: a mergeable sketch for each key and date beside its counts.

Sketches of any dates merge, and a merged sketch brackets each quantile. One pass over the range then
counts what lies outside the brackets and keeps what lies inside, which gives the exact quantile;
mean, deviation and extremes come from the stored sums alone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.aggregate import QUARTILES
from tickloom.operators.partials import both
from tickloom.operators.quantiles import exact_quantiles
from tickloom.sources.versions import BATCH, MergeStore

#: Size of a sketch, and the share of ranks that a bracket adds on either side: several times the error
#: of a sketch of that size. A quantile outside its bracket is looked up again in a wider one.
K, MARGIN = 800, 0.02
DAILY = T.StructType([
    T.StructField("coin_id", T.StringType(), True), T.StructField("day", T.DateType(), True), T.StructField("n", T.LongType(), True),
    *(T.StructField(c, T.DoubleType(), True) for c in ("mean", "m2", "low", "high")), T.StructField("sketch", T.BinaryType(), True),
])


def daily_sketches(df: DataFrame, value: str = "price_usd", ts: str = "fetched_at", key: str = "coin_id", k: int = K) -> DataFrame:
    """One row for each key and date with the counts and the sketch of its values; rows without a value
    or time are left out."""
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x) & F.col(ts).isNotNull())
    return rows.groupBy(F.col(key).alias("coin_id"), F.to_date(ts).alias("day")).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"),
        F.max(x).alias("high"), F.kll_sketch_agg_double(x, k).alias("sketch"),
    )


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return rows.groupBy(*keys).agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("n", "mean", "m2"))), none, both).alias("_all"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"), F.max(BATCH).alias(BATCH),
    ).select(*keys, "_all.*", "low", "high", "sketch", BATCH)


def sketch_store(spark: SparkSession, path: str) -> MergeStore:
    """Daily sketches that batches add to."""
    return MergeStore(spark, path, DAILY, lambda rows: _merged(rows, "coin_id", "day"), date_of="day")


def stored_distribution(
    store: MergeStore, rows: DataFrame, value: str = "price_usd", ts: str = "fetched_at",
    since: date | None = None, until: date | None = None, margin: float = MARGIN,
) -> DataFrame:
    """Box statistics per key over the dates from ``since`` to ``until``, both included, as
    ``aggregate.distribution`` gives them. ``rows`` are the stored values; they are read once."""
    kept = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(ts).isNotNull())
    for bound, compare in ((since, "__ge__"), (until, "__le__")):
        if bound is not None:
            kept = kept.where(getattr(F.to_date(ts), compare)(F.lit(bound)))
    days = store.read((since, until)).withColumn(BATCH, F.lit(0))
    about = _merged(days, "coin_id")
    names = sorted(QUARTILES, key=QUARTILES.get)
    ranks = [e for n in names for e in (max(QUARTILES[n] - margin, 0.0), min(QUARTILES[n] + margin, 1.0))]
    brackets = about.select(
        "coin_id", F.col("n").alias("_n"), F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(r)) for r in ranks)).alias("_edge")
    )
    quartiles = exact_quantiles(kept, value, QUARTILES, "coin_id", margin=margin, brackets=brackets)
    spread = F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))
    return about.select(
        "coin_id", "n", "mean", F.when(F.col("n") > 1, spread).alias("sd"), F.col("low").alias("min"), F.col("high").alias("max")
    ).join(quartiles, "coin_id")
