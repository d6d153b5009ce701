"""The pipeline against the same steps by brute force, and the registered queries."""

import glob
import os
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.cases import odd_docs, words
from tests.llm.test_operators import brute_classes, brute_quality, shingles
from tickloom.llm import secrets
from tickloom.llm.queries import QUERIES, TOKENIZER
from tickloom.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry_points.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "secret_scan", "packing"]


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [(d, t) for d, t in rows if brute_quality_fast(t)]
    keep = {c for _, c, _ in brute_classes(rows)}
    rows = [(d, t) for d, t in rows if d in keep]
    rows = [(d, t) for d, t in rows if not any(len(q & shingles(t)) >= 0.8 * len(q) - 1e-9 for q in items)]
    clean = spark.createDataFrame(rows, "doc_id long, text string")
    models = secrets.train(clean)
    want = {r["doc_id"]: r["text"] for r in secrets.redact(clean, models).collect()}

    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces, sequences = defaultdict(list), defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]] += r["length"]
    assert set(pieces) == set(want)
    for doc, text in want.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert all(n == 1024 or n & (n - 1) == 0 for n in sequences.values())


def brute_quality_fast(text):
    """brute_quality's verdict; its quadratic part only where a repeat may matter."""
    w = words(text)
    five = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    if len(w) >= 10 and len(set(five)) == len(five):
        return True
    return brute_quality(text)[6] if len(w) < 400 else _long_verdict(w)


def _long_verdict(w):
    def covered(k):
        seen = defaultdict(list)
        for i in range(len(w) - k + 1):
            seen[tuple(w[i : i + k])].append(i)
        return {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(k)}

    return 100 * len(covered(5)) <= 20 * len(w) and len(covered(10)) <= 0.2 * len(w) and not covered(100)


def test_stages_take_odd_rows(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    got, want = QUERIES[name](spark, SF).toPandas(), tables.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    order = sorted(got.columns)
    as_rows = lambda df: sorted(tuple(map(str, r)) for r in df[order].astype(object).where(df[order].notna(), None).itertuples(index=False))
    assert as_rows(got) == as_rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_query_runs(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = QUERIES[name](spark, SF)
    assert got.select("doc_id").distinct().count() == n
