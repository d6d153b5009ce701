"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from tickloom.plans.catalog import QUERIES
from tickloom.session import build_session

HEADLINE = (
    "gold_1h", "gold_10s", "resample_5m", "status_by_key", "price_distribution", "correlation_matrix",
    "sma_20", "rsi_14", "technical_panel", "technical_panel_parts", "signals", "alerts_fired",
    "forecast_linear", "forecast_ar", "forecast_ar_parts", "forecast_seasonal", "explorer_500",
    "stream_gold", "stream_indicators",
)
RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffled(spark) -> int:
    """Bytes written to shuffles so far in this session."""
    sc = spark.sparkContext
    none = sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.retainedStages": "100000",
    })
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm, moved = {}, {}, {}
    for name in HEADLINE:
        before = shuffled(spark)
        cold[name] = round(seconds(spark, name, folder), 3)
        moved[name] = shuffled(spark) - before
        warm[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "sum of warm medians", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "shuffle_bytes": moved, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
