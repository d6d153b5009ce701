"""Batch cycle: new raw files -> bronze -> silver -> touched gold windows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.aggregate import to_gold
from tickloom.operators.clean import drop_unusable, normalize_types, to_silver
from tickloom.operators.partials import PARTIAL, gold_of, gold_partials, merge_partials
from tickloom.schemas import BRONZE, SILVER
from tickloom.sources.layers import BATCH, DATE, apply_retention, read_layer, write_layer
from tickloom.sources.raw import ARRIVAL, path_exists, raw_files, read_raw
from tickloom.sources.versions import Conflict, Manifest, MergeStore

LEDGER = T.StructType([T.StructField("arrival_file", T.StringType(), True)])


def refine(raw: DataFrame, arrival: Iterable[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bronze, silver, gold) of raw rows, lazily. ``arrival`` orders the copies of a tick."""
    bronze = normalize_types(raw)
    silver = to_silver(bronze, arrival)
    return bronze, silver, to_gold(silver)


def unseen_files(spark: SparkSession, raw_path: str, out_path: str, batch_id: int) -> DataFrame:
    """Raw files that no other cycle has taken: (path, arrival_file)."""
    ledger = read_layer(spark, f"{out_path}/files", LEDGER, more=[BATCH])
    files = raw_files(spark, raw_path).select("path", "arrival_file")
    if BATCH not in ledger.columns:
        return files
    return files.join(ledger.where(F.col(BATCH) != batch_id), "arrival_file", "left_anti")


def gold_store(spark: SparkSession, out_path: str) -> MergeStore:
    """The gold windows of the cycles, as partial rows that later ticks are added to."""
    return MergeStore(spark, f"{out_path}/gold", PARTIAL, merge_partials, date_of="window_start")


def read_gold(spark: SparkSession, out_path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """The gold layer of the cycles. The bounds are dates of ``window_start``, both included, and open
    only the folders of those dates."""
    return gold_of(gold_store(spark, out_path).read((since, until)))


def _same_width(spark: SparkSession, out_path: str, width: str) -> None:
    settings = Manifest(spark, f"{out_path}/settings")
    version, known = settings.read()
    if version == 0:
        try:
            settings.commit(0, {"width": width})
            return
        except Conflict:
            known = settings.read()[1]
    if known["width"] != width:
        raise ValueError(f"the gold windows of {out_path} are {known['width']} wide, not {width}")


def run_cycle(
    spark: SparkSession, raw_path: str, out_path: str, batch_id: int = 0, width: str = "10 seconds",
    on_corrupt: str = "file", keep_hours: float | None = None, archive: str | None = None,
    counts: dict[str, int] | None = None,
) -> bool:
    """One cycle over the raw files that no earlier cycle has taken. False if there is none.

    New ticks are cleaned and joined against the silver of the dates they touch, so that a tick is
    stored once whatever cycle brings its copies. What is new is added up by gold window, of any
    ``width`` (the same for all cycles), and stored as partial rows beside those of earlier cycles;
    ``read_gold`` merges them. No silver is read for that but the cycle's own. Each layer is written
    once and read back by the next. The list of files is written last: a cycle that fails is repeated
    with its ``batch_id`` and replaces its own output. ``keep_hours`` then deletes, or moves to
    ``archive``, raw files older than that. ``counts`` gets the rows of each layer, which Spark counts
    while it writes them.
    """
    seen = {name: Observation(name) for name in ("bronze_rows", "silver_rows", "gold_windows")}

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df if counts is None else df.observe(seen[name], F.count(F.lit(1)).alias("n"))

    new = [r["path"] for r in unseen_files(spark, raw_path, out_path, batch_id).collect()]
    if not new:
        return False
    _same_width(spark, out_path, width)
    raw = read_raw(spark, raw_path, on_corrupt=on_corrupt, with_arrival=True, files=new)
    write_layer(counted(normalize_types(raw), "bronze_rows"), f"{out_path}/bronze", "fetched_at", batch_id)
    bronze = read_layer(
        spark, f"{out_path}/bronze/{BATCH}={batch_id}", T.StructType(BRONZE.fields + ARRIVAL.fields)
    )
    fresh = to_silver(bronze, ARRIVAL.fieldNames()).drop(*ARRIVAL.fieldNames())
    # Only the date folders that the new ticks touch are opened; copies of a tick have one date.
    touched = drop_unusable(bronze).select(F.to_date("fetched_at").alias(DATE)).distinct()
    if path_exists(spark, f"{out_path}/silver"):
        stored = read_layer(spark, f"{out_path}/silver", SILVER, more=[BATCH, DATE])
        same_tick = (
            stored.where(F.col(BATCH) != batch_id).join(touched, stored[DATE].eqNullSafe(touched[DATE]), "left_semi")
            .select(F.col("coin_id").alias("_coin"), F.col("fetched_at").alias("_at"))
        )
        fresh = fresh.join(
            same_tick, F.col("coin_id").eqNullSafe(F.col("_coin")) & F.col("fetched_at").eqNullSafe(F.col("_at")), "left_anti"
        )
    write_layer(counted(fresh, "silver_rows"), f"{out_path}/silver", "fetched_at", batch_id)
    mine = read_layer(spark, f"{out_path}/silver/{BATCH}={batch_id}", SILVER)
    gold_store(spark, out_path).write(counted(gold_partials(mine, width), "gold_windows"), batch_id)
    if counts is not None:
        counts.update({name: observation.get["n"] for name, observation in seen.items()})
    # Files without a readable record, such as a partly written one, are looked at again.
    taken = bronze.select("arrival_file").distinct()
    taken.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/files/{BATCH}={batch_id}")
    if keep_hours is not None:
        apply_retention(spark, raw_path, keep_hours, archive=archive)
    return True
