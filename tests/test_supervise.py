import json
from datetime import datetime, timedelta

import pytest

from tickloom.operators.clean import normalize_types
from tickloom.plans import medallion, supervise
from tickloom.streaming import flows

START = datetime(2024, 1, 1)


def land(folder, name, prices):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"coin_id": "a", "price_usd": p, "fetched_at": (START + timedelta(minutes=p)).isoformat() + "+00:00"}) for p in prices]
    (folder / name).write_text("\n".join(lines))


def test_a_failed_cycle_does_not_end_the_loop(spark, tmp_path):
    raw, calls = tmp_path / "raw", []
    land(raw, "0.jsonl", [1, 2, 2])

    def cycle(*args, **how):
        calls.append(args[3])
        if len(calls) == 2:
            land(raw, "1.jsonl", [3])
            raise RuntimeError("no disk")
        return medallion.run_cycle(*args, **how)

    last = supervise.run_cycles(spark, str(raw), f"{tmp_path}/out", f"{tmp_path}/log", 4, 0.0, cycle=cycle)
    rows = supervise.EventLog(spark, f"{tmp_path}/log", supervise.CYCLE).read().orderBy("started_at").collect()
    assert calls == [0, 1, 1, 2] and last == 2
    assert [(r.batch_id, r.attempt, r.status, r.bronze_rows, r.silver_rows, r.gold_windows) for r in rows] == [
        (0, 0, "done", 3, 2, 2), (1, 0, "failed", None, None, None), (1, 1, "done", 1, 1, 1), (2, 0, "idle", 0, 0, 0),
    ]
    assert "no disk" in rows[1].error and all(r.seconds >= 0 for r in rows)


def test_streams_are_logged_and_started_again(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, "0.jsonl", [1, 2])
    listener, starts = supervise.ProgressListener(spark, f"{tmp_path}/log"), []
    spark.streams.addListener(listener)
    try:
        def start():
            ticks = normalize_types(flows.read_raw_stream(spark, str(raw)))
            starts.append(1)

            def write(batch, batch_id):
                if len(starts) == 1:
                    raise RuntimeError("sink is away")
                batch.write.mode("overwrite").parquet(f"{tmp_path}/out")

            return flows.each_batch(ticks, write, f"{tmp_path}/cp", interval=None)

        supervise.keep_running(start, 3, 0.0)
        with pytest.raises(Exception, match="always"):
            supervise.keep_running(lambda: (_ for _ in ()).throw(RuntimeError("always")), 1, 0.0)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    assert len(starts) == 2 and spark.read.parquet(f"{tmp_path}/out").count() == 2
    log = supervise.EventLog(spark, f"{tmp_path}/log", supervise.PROGRESS).read().collect()
    events = [r.event for r in log]
    assert events.count("started") == 2 and "failed" in events and "progress" in events
    assert any("sink is away" in (r.error or "") for r in log) and max(r.input_rows or 0 for r in log) == 2
