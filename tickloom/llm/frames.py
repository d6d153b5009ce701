"""Small Spark helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialize, scratch_path

__all__ = ["column", "documents", "map_rows", "materialize", "small_enough", "spread", "union_find", "written"]

#: Bytes of a table that may be broadcast.
BROADCAST = 64 << 20


def column(name: str) -> Column:
    """A column by its plain name, also if the name has dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder of the shared storage and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text as string, and the named columns; other columns are left behind."""
    return docs.select(
        column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"), *map(column, more)
    )


def map_rows(docs: DataFrame, rows) -> DataFrame:
    """mapInArrow that keeps all columns. Columns are told by position, so any name is fine: the
    batches' columns are called ``0``, ``1`` and so on."""
    numbered = docs.toDF(*(str(i) for i in range(len(docs.columns))))
    return numbered.mapInArrow(rows, numbered.schema).toDF(*docs.columns)


def small_enough(df: DataFrame, row_bytes: int, limit: int = BROADCAST) -> DataFrame:
    """The table, written, and marked for a broadcast if it has at most that many bytes: its rows are counted."""
    own = written(df, "small")
    return F.broadcast(own) if own.count() * row_bytes <= limit else own


def spread(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def union_find(links: DataFrame) -> DataFrame:
    """Components of an undirected graph given as rows (a, b): rows (node, root), root the smallest node.

    Each round points every node at the smallest node that it or a neighbour knows, then at that
    node's own pointer. The rounds are written, so a round never repeats the earlier ones; their
    number grows with the logarithm of a component's width. Nothing but one count reaches the driver.
    """
    edges = materialize(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    )
    state = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
    while True:
        offers = (
            edges.join(state.select(F.col("node").alias("a"), "root"), "a")
            .select(F.col("b").alias("node"), "root")
            # The root of a node hears of it too, so that a long chain folds in few rounds.
            .union(edges.join(state.select(F.col("node").alias("a"), "root"), "a")
                   .join(state.select(F.col("node").alias("b"), F.col("root").alias("other")), "b")
                   .select(F.greatest("root", "other").alias("node"), F.least("root", "other").alias("root")))
        )
        best = offers.groupBy("node").agg(F.min("root").alias("heard"))
        step = (
            state.join(best, "node", "left")
            .select("node", "root", F.least("root", F.coalesce("heard", "root")).alias("next"))
        )
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        new = materialize(
            step.join(jump, "next", "left")
            .select("node", F.least("next", F.coalesce("beyond", "next")).alias("root"),
                    (F.col("root") != F.least("next", F.coalesce("beyond", "next"))).alias("moved"))
        )
        state = new.select("node", "root")
        if not new.where("moved").limit(1).count():
            return state
