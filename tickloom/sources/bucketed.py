"""Layers in buckets by key: rows of a key lie in one bucket, in time order, so that copy tests, gold
windows and per-key windows over them need no shuffle.

Buckets are a property of a table in the session's catalog. ``write_bucketed`` makes the table and its
files; ``open_bucketed`` makes the table again, in a later session, over the same files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of a bucket to aim at; a bucket is read by one task.
BUCKET_BYTES = 256 << 20


def buckets_for(total_bytes: int, least: int = 8) -> int:
    """A power of two, so that layers of different sizes still match bucket by bucket."""
    return max(least, 1 << max(0, -(-total_bytes // BUCKET_BYTES) - 1).bit_length())


def _name(table: str) -> str:
    if not re.fullmatch(r"\w+", table):
        raise ValueError(f"a table's name is letters, digits and underscores: {table!r}")
    return table


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, key: str = "coin_id", order: Sequence[str] = ("fetched_at",), mode: str = "errorifexists",
) -> DataFrame:
    """Store ``df`` as a table of so many buckets, one file each, and give it back as it is read."""
    rows = df.repartition(buckets, key)
    rows.write.mode(mode).bucketBy(buckets, key).sortBy(key, *order).option("path", path).format("parquet").saveAsTable(_name(table))
    return df.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, schema: T.StructType, buckets: int, key: str = "coin_id", order: Sequence[str] = ("fetched_at",),
) -> DataFrame:
    """The table over files that ``write_bucketed`` has stored with the same buckets, key and order."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sorted_by = ", ".join(f"`{c}` ASC" for c in (key, *order))
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(table)} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY ({sorted_by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)
