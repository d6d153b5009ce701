"""The engine's input shapes as views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.aggregate import resample, to_gold
from tickloom.operators.clean import as_series, normalize_types, to_silver
from tickloom.scale import KeyProfile, profile
from tickloom.schemas import SILVER_SERIES, Series
from tickloom.session import use_utc

TICKS = SILVER_SERIES.but(tiebreak=("seq",))
PARTS = Series(tiebreak=("l_orderkey", "l_linenumber"))


class Fixtures:
    """Ticks from ``events``, a many-key series from ``lineitem``, rules from ``orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def ticks(self) -> DataFrame:
        """Clean ticks with unique times per key."""
        value = F.col("value")
        return self.table("events").select(
            F.col("event_id").alias("seq"), F.col("event_type").alias("coin_id"),
            F.col("ts").cast("timestamp").alias("fetched_at"), value.alias("price_usd"),
            (value * 1000000).alias("market_cap_usd"),
            F.get_json_object("props", "$.k").cast("double").alias("volume_24h_usd"),
            ((value - 50) * 4).alias("change_24h_pct"),
        )

    def dirty(self) -> DataFrame:
        """Ticks with missing keys and times, bad and negative prices, and later copies."""
        ticks = self.ticks()

        def every(n: int, then) -> F.Column:
            return F.when(F.col("seq") % n == 0, then)

        price = F.col("price_usd").cast("string")
        bad_price = every(17, F.lit(None)).otherwise(
            every(19, F.lit("n/a")).otherwise(every(23, F.lit("-1")).otherwise(price))
        )
        first = ticks.select(
            (F.col("seq") * 2).alias("seq"),
            every(29, F.lit(None)).otherwise(F.col("coin_id")).alias("coin_id"),
            every(31, F.lit(None)).otherwise(F.col("fetched_at")).alias("fetched_at"),
            bad_price.alias("price_usd"),
            every(37, F.lit(None)).otherwise(F.col("change_24h_pct")).alias("change_24h_pct"),
            "volume_24h_usd",
        )
        copies = ticks.where("price_usd > 30").select(
            (F.col("seq") * 2 + 1).alias("seq"), "coin_id", "fetched_at",
            (F.col("price_usd") + 1).cast("string").alias("price_usd"), "change_24h_pct", "volume_24h_usd",
        )
        return first.unionByName(copies)

    def silver(self) -> DataFrame:
        return to_silver(normalize_types(self.dirty()), ["seq"])

    def gold(self, width: str = "10 seconds") -> DataFrame:
        """Gold of the clean ticks."""
        return to_gold(self.ticks(), width)

    def hourly(self) -> DataFrame:
        """Gold resampled to one hour."""
        return resample(self.gold(), "1h")

    def tick_profile(self) -> KeyProfile:
        """Key sizes of the ticks: a bound for gold and its bins, without computing them."""
        return profile(self.ticks(), TICKS)

    def series(self) -> DataFrame:
        """Canonical series of the ticks: few keys, long histories."""
        return as_series(self.ticks(), TICKS)

    def parts(self) -> DataFrame:
        """Canonical series of the parts: many keys, short histories, times with ties."""
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("coin_id"),
            F.col("l_shipdate").cast("timestamp").alias("ts"), "l_orderkey", "l_linenumber",
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("value"),
            F.col("l_quantity").alias("volume"), ((F.col("l_discount") - 0.05) * 100).alias("change"),
        )

    def raw_text(self) -> DataFrame:
        """Dirty ticks as a producer writes them: ISO text times."""
        iso = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        return self.dirty().withColumn("fetched_at", iso)

    def snapshots(self) -> DataFrame:
        """API replies: per hour, one object with the last price and volume of every key."""
        hour = F.date_trunc("hour", "fetched_at").alias("hour")
        last = self.ticks().groupBy(hour, "coin_id").agg(
            F.max_by("price_usd", "fetched_at").alias("p"), F.max_by("volume_24h_usd", "fetched_at").alias("v")
        )
        metrics = F.create_map(F.lit("usd"), F.col("p"), F.lit("usd_24h_vol"), F.col("v"))
        reply = F.map_from_entries(F.collect_list(F.struct("coin_id", metrics)))
        return last.groupBy("hour").agg(F.to_json(reply).alias("payload")).select(
            "payload", F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("fetched_at")
        )

    def rules(self) -> DataFrame:
        """Alert rules from ``orders``: some inactive, some of an unknown type or key."""
        names = F.array(*[F.lit(n) for n in ("click", "view", "error", "purchase", "signup", "absent")])
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.element_at(names, (F.col("o_custkey") % 6 + 1).cast("int")).alias("coin"),
            F.when(status == "F", "price").when(status == "O", "change_24h").otherwise("volume").alias("type"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), "above").otherwise("below").alias("condition"),
            (F.col("o_totalprice") / 10000).alias("threshold"), (priority != "5-LOW").alias("active"),
        )

    def gappy(self) -> DataFrame:
        """Hourly gold in which one key has a missing volume."""
        gap = (F.col("coin_id") == "click") & (F.col("record_count") == 1)
        return self.hourly().withColumn("avg_volume", F.when(~gap, F.col("avg_volume")))

    def supplier_series(self) -> DataFrame:
        """Twelve keys from ``lineitem``."""
        return self.table("lineitem").select(
            (F.col("l_suppkey") % 12).cast("string").alias("coin_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
            "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("value"),
        )

    def history(self, above: float | None = 60.0) -> DataFrame:
        """Alert history: every tick above a price, or every tick, in arrival order."""
        return self.ticks().where(F.lit(True) if above is None else F.col("price_usd") > above).select(
            "seq", F.date_format("fetched_at", "HH:mm:ss").alias("time"), F.upper("coin_id").alias("coin"),
            F.lit("price").alias("type"), F.concat(F.upper("coin_id"), F.lit(" above 60.0")).alias("message"),
        )
