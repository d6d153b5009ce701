import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.aggregate import to_gold
from tickloom.operators.alerts import add_rule, remove_rules
from tickloom.operators.partials import gold_of, gold_partials, merge_partials
from tickloom.plans.medallion import read_gold, run_cycle
from tickloom.schemas import ALERT_RULE, GOLD, SILVER
from tickloom.sources.layers import read_json_table, read_layer, write_json_table
from tickloom.sources.versions import BATCH, Conflict, Manifest, MergeStore, VersionedTable

START = datetime(2024, 1, 1)


def rules(spark, n):
    return spark.createDataFrame([(i, "bitcoin", "price", "above", float(i), True) for i in range(n)], ALERT_RULE)


def test_a_manifest_version_is_written_once(spark, tmp_path):
    first, second = (Manifest(spark, f"{tmp_path}/m") for _ in range(2))
    assert first.read() == (0, None)
    assert first.commit(0, {"a": 1}) == 1
    with pytest.raises(Conflict):
        second.commit(0, {"a": 2})
    assert second.read() == (1, {"a": 1}) and second.commit(1, [3]) == 2
    assert first.read() == (2, [3]) and first.read(1) == (1, {"a": 1})
    with pytest.raises(KeyError):
        first.read(9)
    assert not [n for n in os.listdir(tmp_path / "m" / "_manifest") if n.startswith("draft")]


def test_rules_are_changed_and_saved(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/rules", ALERT_RULE, keep=3)
    assert table.read().count() == 0 and table.version() == 0
    assert table.save(rules(spark, 3)) == 1
    assert table.update(lambda r: add_rule(r, "solana", "price", "below", 2.0, START)) == 2
    assert table.update(lambda r: remove_rules(r, spark.createDataFrame([(1,)], "id long"))) == 3
    assert sorted(r.coin for r in table.read().collect()) == ["bitcoin", "bitcoin", "solana"]
    assert table.read(1).count() == 3
    for _ in range(4):
        table.update(lambda r: r)
    assert table.read().count() == 3 and len([n for n in os.listdir(tmp_path / "rules") if n[0] == "v"]) == 3


def test_a_failed_save_leaves_the_version_before(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/rules", ALERT_RULE)
    table.save(rules(spark, 4))
    broken = table.read().withColumn("threshold", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        table.save(broken)
    assert table.version() == 1 and table.read().count() == 4


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    mine, other = (VersionedTable(spark, f"{tmp_path}/rules", ALERT_RULE) for _ in range(2))
    mine.save(rules(spark, 1))
    seen = mine.version()
    other.update(lambda r: add_rule(r, "solana", "price", "above", 1.0, START))
    with pytest.raises(Conflict):
        mine.save(rules(spark, 9), expected=seen)
    assert mine.read().count() == 2
    calls = []

    def change(r):
        calls.append(1)
        if len(calls) == 1:
            other.update(lambda x: add_rule(x, "ripple", "price", "above", 1.0, START + timedelta(1)))
        return add_rule(r, "cardano", "price", "above", 1.0, START + timedelta(2))

    mine.update(change)
    assert len(calls) == 2 and mine.read().count() == 4


def test_a_json_table_may_be_saved_over_itself(spark, tmp_path):
    path = f"{tmp_path}/rules"
    write_json_table(rules(spark, 5), path)
    write_json_table(add_rule(read_json_table(spark, path, ALERT_RULE), "solana", "price", "above", 1.0, START), path)
    assert read_json_table(spark, path, ALERT_RULE).count() == 6
    bad = read_json_table(spark, path, ALERT_RULE).withColumn("coin", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        write_json_table(bad, path)
    assert read_json_table(spark, path, ALERT_RULE).count() == 6


def newest(rows):
    return rows.groupBy("k").agg(F.max_by("v", BATCH).alias("v"), F.max(BATCH).alias(BATCH))


def test_many_batches_leave_few_folders(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    store = MergeStore(spark, f"{tmp_path}/s", schema, newest, fanout=3)
    assert store.read().count() == 0
    want = {}
    for i in range(40):
        want |= {i % 7: i, 100 + i: i}
        batch = spark.createDataFrame([(i % 7, i), (100 + i, i)], schema).coalesce(1)
        store.write(batch, i)
        if i % 9 == 4:  # a repeated batch replaces its rows
            store.write(batch, i)
    assert {r.k: r.v for r in store.read().collect()} == want
    assert len(store.folders()) <= 3 * 4
    assert len([n for n in os.listdir(tmp_path / "s") if n.startswith("part=")]) <= 3 * 4 + 4
    with pytest.raises(ValueError, match="older"):
        store.write(batch, 3)


def test_merged_parts_equal_the_whole(spark, rows):
    ticks = [("a", START + timedelta(seconds=7 * i), 1e9 + (i * 37) % 11, float(i) if i % 3 else None, None if i % 5 == 0 else 0.5 * i) for i in range(200)]
    ticks += [("b", START, 3.0, None, None), ("b", START + timedelta(1), None, 1.0, 2.0), (None, START, 1.0, 1.0, 1.0), ("c", None, 1.0, 1.0, 1.0)]
    frame = spark.createDataFrame(ticks, "coin_id string, fetched_at timestamp, price_usd double, volume_24h_usd double, change_24h_pct double")
    parts = [gold_partials(frame.where(F.abs(F.xxhash64("fetched_at", "price_usd")) % 3 == i), "5 minutes").withColumn(BATCH, F.lit(i)) for i in range(3)]
    merged = gold_of(merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    assert rows(merged, 4) == rows(to_gold(frame, "5 minutes").select(*merged.columns), 4)


def line(coin, price, at):
    return json.dumps({"coin_id": coin, "price_usd": price, "fetched_at": at.isoformat() + "+00:00", "change_24h_pct": 1.0, "volume_24h_usd": 2.0})


@pytest.mark.parametrize("width", ["7 minutes", "2 days", "1 hour"])
def test_cycles_of_any_width(spark, tmp_path, rows, width):
    """Cycles that meet inside a window, also one over midnight, give the gold of all ticks."""
    raw = tmp_path / "raw"
    raw.mkdir()
    cuts = [[0, 9 * 60, 14 * 60 + 57, 23 * 60 + 56], [23 * 60 + 58, 24 * 60 + 1, 9 * 60 + 1], [24 * 60 + 2, 50 * 60]]
    for i, minutes in enumerate(cuts):
        (raw / f"{i}.jsonl").write_text("\n".join(line(c, 10.0 * m + i, START + timedelta(minutes=m)) for m in minutes for c in "ab"))
        assert run_cycle(spark, str(raw), f"{tmp_path}/out", i, width)
        silver = read_layer(spark, f"{tmp_path}/out/silver", SILVER)
        got = read_gold(spark, f"{tmp_path}/out")
        assert got.columns == GOLD.fieldNames() and rows(got) == rows(to_gold(silver, width))
    assert run_cycle(spark, str(raw), f"{tmp_path}/out", 2, width)
    silver, got = read_layer(spark, f"{tmp_path}/out/silver", SILVER), read_gold(spark, f"{tmp_path}/out")
    assert rows(got) == rows(to_gold(silver, width))
    with pytest.raises(ValueError, match="wide"):
        (raw / "9.jsonl").write_text(line("a", 1.0, START + timedelta(9)))
        run_cycle(spark, str(raw), f"{tmp_path}/out", 3, "3 minutes")
    some = read_gold(spark, f"{tmp_path}/out", since=date(2024, 1, 2))
    assert rows(some) == [r for r in rows(got) if r[1] >= datetime(2024, 1, 2)]
    assert "PartitionFilters: [isnotnull(dt" in some._jdf.queryExecution().executedPlan().toString()
