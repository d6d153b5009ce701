"""Cross-key comparison: normalised values, returns, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import percent_change
from tickloom.operators.aggregate import earliest_of
from tickloom.operators.filters import min_history, select_keys
from tickloom.scale import KeyProfile, join_stats, ordered, over_rows, profile, with_ordinal
from tickloom.schemas import SERIES, Series

RETURN_MIN_ROWS = 5
WIDE_KEYS = 8
CELLS_PER_TASK = 500_000
DENSE_CELLS = 2_000_000
KEYS_PER_BLOCK = 1_000
PAIR_SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def normalized(df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None) -> DataFrame:
    """Value relative to the key's first value, base 100. One-row keys and base 0 are left out."""
    size = size or profile(df, by)
    base = df.groupBy(by.key).agg(
        earliest_of(by.value, by).alias("_base"), F.count(F.lit(1)).alias("_n")
    ).where("_n >= 2 AND _base <> 0").select(by.key, "_base")
    scaled = join_stats(df, base, by.key, size)
    return scaled.withColumn("normalized", F.col(by.value) / F.col("_base") * 100).drop("_base")


def returns(df: DataFrame, by: Series = SERIES, size: KeyProfile | None = None) -> DataFrame:
    """``return_pct`` against the row before, for keys with five rows or more.

    The first row of a key, and rows after a value of 0, have no return and are dropped.
    """
    size = size or profile(df, by)

    def step(rows: DataFrame, part: list[str]) -> DataFrame:
        before = F.lag(by.value).over(ordered(part, by))
        return rows.withColumn("return_pct", percent_change(by.value, before))

    narrow = df.select(by.key, *by.order, by.value)
    return over_rows(min_history(narrow, RETURN_MIN_ROWS, by, size), step, 1, by, size).where(
        F.col("return_pct").isNotNull()
    )


def _correlation(n, sa, sb, saa, sbb, sab):
    """Pearson correlation from sums; null when a side is constant."""
    cov = sab - sa * sb / n
    spread = F.sqrt(F.greatest(saa - sa * sa / n, F.lit(0.0)) * F.greatest(sbb - sb * sb / n, F.lit(0.0)))
    return _bounded(F.when(n >= 2, F.try_divide(cov, spread)))


def _bounded(c):
    """Rounding may carry a correlation past 1 by the last digit; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))


def _wide_correlation(cells: DataFrame, names: list[str]) -> DataFrame:
    """Few keys: one column per key, then one partially aggregated row for all pairs."""
    wide = cells.groupBy("_at").pivot("_key", names).agg(F.avg("_x"))
    wide = wide.toDF("_at", *[f"k{i}" for i in range(len(names))])
    entries = []
    for i, j in combinations_with_replacement(range(len(names)), 2):
        a, b = F.col(f"k{i}"), F.col(f"k{j}")
        both = a.isNotNull() & b.isNotNull()
        a, b = F.when(both, a), F.when(both, b)
        value = _correlation(F.count(a), F.sum(a), F.sum(b), F.sum(a * a), F.sum(b * b), F.sum(a * b))
        for left, right in {(i, j), (j, i)}:
            entries.append(F.struct(
                F.lit(names[left]).alias("coin_a"), F.lit(names[right]).alias("coin_b"),
                value.alias("correlation"),
            ))
    packed = wide.agg(F.array(*entries).alias("_e"))
    return packed.select(F.explode("_e").alias("_e")).select("_e.*")


def _pair_sums(cells: pd.DataFrame) -> pd.DataFrame:
    """Sums per key pair over the positions of one chunk, for one pair of key blocks.

    Positions are taken in slabs, so the dense matrices stay small however sparse the cells are.
    """
    p, q = int(cells["_p"].iloc[0]), int(cells["_q"].iloc[0])
    at, _ = pd.factorize(cells["_at"])
    block, value = cells["_block"].to_numpy(), cells["_x"].to_numpy()

    def side(number: int):
        rows = np.flatnonzero(block == number)
        rows = rows[np.argsort(at[rows], kind="stable")]
        codes, names = pd.factorize(cells["_key"].iloc[rows], sort=True)
        return at[rows], codes, value[rows], np.asarray(names, dtype=object)

    def dense(one, start: int, stop: int):
        position, codes, x, names = one
        low, high = np.searchsorted(position, [start, stop])
        values, seen = np.zeros((stop - start, len(names))), np.zeros((stop - start, len(names)))
        values[position[low:high] - start, codes[low:high]] = x[low:high]
        seen[position[low:high] - start, codes[low:high]] = 1.0
        return values, seen

    left = side(p)
    right = left if p == q else side(q)
    a, b = left[3], right[3]
    slab = max(1, DENSE_CELLS // max(len(a), len(b), 1))
    sums = {name: np.zeros((len(a), len(b))) for name in PAIR_SUMS}
    for start in range(0, int(at.max()) + 1, slab):
        stop = min(start + slab, int(at.max()) + 1)
        xa, ma = dense(left, start, stop)
        xb, mb = (xa, ma) if p == q else dense(right, start, stop)
        for name, part in zip(PAIR_SUMS, (
            ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb,
        )):
            sums[name] += part
    keep = sums["n"] > 0
    if p == q:
        keep &= np.triu(np.ones_like(keep, dtype=bool))
    i, j = np.nonzero(keep)
    return pd.DataFrame({"coin_a": a[i], "coin_b": b[j], **{k: v[i, j] for k, v in sums.items()}})


def _chunked_correlation(cells: DataFrame, keys: int, rows: int, unique: bool) -> DataFrame:
    """Any number of keys: a blocked matrix product.

    Positions are hashed into chunks and keys into blocks, so a task holds a bounded number
    of cells and emits one sum per key pair, not one row per pair and position.
    """
    blocks = -(-keys // KEYS_PER_BLOCK)
    chunks = max(1, -(-rows // CELLS_PER_TASK))
    block = F.pmod(F.xxhash64("_key"), F.lit(blocks)).cast("int")
    if not unique:  # rows that share a position count with their mean
        cells = cells.groupBy("_at", "_key").agg(F.avg("_x").alias("_x"))
    spread = (
        cells.withColumn("_chunk", F.pmod(F.xxhash64("_at"), F.lit(chunks)))
        .withColumn("_block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("_p", F.least("_block", "_other")).withColumn("_q", F.greatest("_block", "_other"))
        .drop("_other")
    )
    sums = spread.groupBy("_chunk", "_p", "_q").applyInPandas(
        _pair_sums, "coin_a string, coin_b string, " + ", ".join(f"{c} double" for c in PAIR_SUMS)
    )
    total = sums.groupBy("coin_a", "coin_b").agg(
        *[F.sum(c).alias(c) for c in PAIR_SUMS]
    )
    upper = total.select("coin_a", "coin_b", _correlation(
        *[F.col(c) for c in PAIR_SUMS]
    ).alias("correlation"))
    mirrored = upper.where("coin_a <> coin_b").select(
        F.col("coin_b").alias("coin_a"), F.col("coin_a").alias("coin_b"), "correlation"
    )
    return upper.unionByName(mirrored)


def correlation_matrix(
    df: DataFrame, keys: Sequence[str] | None = None, by: Series = SERIES, align: str = "ordinal",
    bucket: str | None = None, size: KeyProfile | None = None, method: str = "auto",
) -> DataFrame:
    """Pairwise Pearson correlation (coin_a, coin_b, correlation), both triangles.

    ``align="ordinal"`` pairs the n-th rows of two keys; ``"time"`` pairs equal times, or
    equal ``bucket`` windows ("1 hour"). Fewer than two keys give an empty result. Up to eight
    keys take one pivot unless ``method="chunked"``; more always take the blocked product. Both
    compute the same sums.
    """
    rows = select_keys(df, keys)
    size = size if size is not None and not keys else profile(rows, by)
    schema = "coin_a string, coin_b string, correlation double"
    if size.keys < 2:
        return df.sparkSession.createDataFrame([], schema)
    narrow = rows.select(by.key, *by.order, by.value)
    if align == "ordinal":
        placed = with_ordinal(narrow, by, size, "_at")
    else:
        placed = narrow.withColumn("_at", F.window(by.ts, bucket).start if bucket else F.col(by.ts))
    # correlation does not change under a shift; centring keeps the sums of squares exact
    centre = rows.groupBy(by.key).agg(F.avg(by.value).alias("_centre"))
    cells = join_stats(placed, centre, by.key, size).where(F.col(by.value).isNotNull()).select(
        "_at", F.col(by.key).alias("_key"), (F.col(by.value) - F.col("_centre")).alias("_x")
    )
    if method in ("auto", "wide") and size.keys <= WIDE_KEYS:
        names = sorted(r[0] for r in rows.select(by.key).distinct().collect())
        return _wide_correlation(cells, names)
    return _chunked_correlation(cells, size.keys, size.rows, align == "ordinal")
