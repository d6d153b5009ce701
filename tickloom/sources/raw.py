"""Raw ticks: JSON-lines files and API snapshots."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import RAW_TEXT

_CORRUPT = "_corrupt"
RAW_GLOB = "*.json*"
ARRIVAL = T.StructType([
    T.StructField("arrival_file", T.StringType(), True),
    T.StructField("arrival_block", T.LongType(), True),
    T.StructField("arrival_line", T.LongType(), True),
])


def read_raw(
    spark: SparkSession, path: str, schema: T.StructType = RAW_TEXT, on_corrupt: str = "file",
    with_arrival: bool = False, files: Sequence[str] | None = None,
) -> DataFrame:
    """All JSON-lines records below a folder as text columns, lazily.

    ``on_corrupt="file"`` leaves out every file that holds an unreadable line (a partly
    written file), ``"record"`` only such lines. A missing or empty folder gives no rows.
    ``with_arrival`` adds the columns that order rows: the file's path below the folder (batch
    folders are named by their time), its block and the line. ``files`` reads these files only.
    """
    wanted = T.StructType(schema.fields + ARRIVAL.fields) if with_arrival else schema
    if not path_exists(spark, path) or (files is not None and not files):
        return spark.createDataFrame([], wanted)
    records = (
        spark.read.schema(T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType(), True)]))
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .option("pathGlobFilter", RAW_GLOB).option("recursiveFileLookup", "true").json(list(files) if files else path)
        .select("*", F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("arrival_block"),
                F.monotonically_increasing_id().alias("arrival_line"))
        .withColumn("arrival_file", below(F.col("_file"), path))
    )
    first = schema.fieldNames()[0]  # the parser must always see a column besides the corrupt one
    whole = records.where(F.col(_CORRUPT).isNull() & (F.length(F.coalesce(F.col(first), F.lit(""))) >= 0))
    if on_corrupt == "file":
        # Names of broken files only, of which the driver has listed all; the records stay where they are.
        broken = records.groupBy("_file").agg(
            F.max(F.col(_CORRUPT).isNotNull()).alias("_broken"), F.count(first).alias("_read")
        ).where("_broken and _read >= 0").select("_file")
        whole = whole.join(F.broadcast(broken), "_file", "left_anti")
    return whole.select(*wanted.fieldNames())


def below(file: Column, path: str) -> Column:
    """A file's path below the folder ``path``."""
    root = path.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_replace(file, f"^.*/{re.escape(root)}/", "")


def write_raw(records: DataFrame, path: str) -> None:
    """Append a batch as JSON lines; a batch without records writes nothing.

    Every batch has a folder named by its time, so that the order of the names is the order
    of arrival. The records are computed once: their number is known when they are written,
    beside ``path``, and the folder takes its place there if it has any.
    """
    spark, counted = records.sparkSession, Observation()
    stamp, draft = f"{time.time_ns():020d}", f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    records.observe(counted, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false").json(draft)
    if counted.get["n"]:
        place_path(spark, draft, f"{path.rstrip('/')}/{stamp}")
    else:
        remove_path(spark, draft)


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw files below a folder, without their contents: (path, arrival_file, modified_at)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, arrival_file string, modified_at timestamp")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", RAW_GLOB).option("recursiveFileLookup", "true").load(path)
    )
    return files.select("path", below(F.col("path"), path).alias("arrival_file"), F.col("modificationTime").alias("modified_at"))


def flatten_snapshot(snapshots: DataFrame, vs_currency: str = "usd") -> DataFrame:
    """API replies ``{coin: {usd, usd_market_cap, ...}}`` to one raw tick per coin.

    ``vs_currency`` selects the prefix of the metrics; a missing metric is null.
    """
    entries = snapshots.select(
        F.explode(F.from_json("payload", "map<string,map<string,double>>")).alias("coin_id", "_m"), "fetched_at"
    )

    def metric(name: str):
        return F.try_element_at("_m", F.lit(name))

    return entries.select(
        "coin_id", metric(vs_currency).alias("price_usd"),
        metric(f"{vs_currency}_market_cap").alias("market_cap_usd"),
        metric(f"{vs_currency}_24h_vol").alias("volume_24h_usd"),
        metric(f"{vs_currency}_24h_change").alias("change_24h_pct"),
        metric("last_updated_at").alias("last_updated"), "fetched_at",
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look-up in whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system the path names; a missing one is fine."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def move_path(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder of the same file system."""
    jvm = spark.sparkContext._jvm
    where, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target)
    system.rename(where, jvm.org.apache.hadoop.fs.Path(target, where.getName()))


def place_path(spark: SparkSession, new: str, path: str) -> None:
    """Give the folder ``new`` the name ``path`` of the same file system."""
    jvm = spark.sparkContext._jvm
    fresh, where = jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(where.getParent())
    if not system.rename(fresh, where):
        raise OSError(f"{path} cannot be written; its content is in {new}")


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``, whose old content is removed last."""
    jvm = spark.sparkContext._jvm
    fresh, where, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (new, path, f"{path.rstrip('/')}-{uuid.uuid4().hex}"))
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = system.exists(where)
    if had and not system.rename(where, old):
        raise OSError(f"{path} cannot be replaced; the new content is in {new}")
    if not system.rename(fresh, where):
        if had:
            system.rename(old, where)
        raise OSError(f"{path} cannot be replaced; the new content is in {new}")
    if had:
        system.delete(old, True)
