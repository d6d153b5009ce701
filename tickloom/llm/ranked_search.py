"""Ranked lexical search for many items at once, by shared partial accumulators.

A document's score for an item is a sum over the item's terms, and items share terms. Items are dealt
into blocks. In a block, shared term sets are mined: the items' terms are written in the order of how
many items hold them, and the most frequent pairs of neighbours are joined into nodes, again and
again, until no two neighbours are shared. The nodes are a graph of sums: a term, or two nodes. For a
group of documents each node's accumulator is computed once, level by level, and an item adds up the
few nodes that it was reduced to.

Documents are read once for each group of blocks that a broadcast can hold (one group, unless the
items are many megabytes). What they hold of the items' terms is written as a table; counts over it
give the weights, and a second reading the scores. Tasks keep the best documents of each item.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import column, documents, written
from tickloom.llm.text import Words, hash_spans, slices

BEST = 50
#: Terms of a block of items on average, documents scored at once, and bytes of items in a broadcast.
BLOCK_TERMS, DOCS, BROADCAST = 30_000, 256, 64 << 20
#: Groups in which the tasks' best documents of an item meet first.
FIRST = 16

#: Bytes between terms: all of ASCII but letters and digits.
GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

TERM = np.dtype([("h", "<u8"), ("check", "<u8")])


def terms_of(texts: pa.Array) -> Words:
    return Words.of(texts, GAP, LOWER)


def named(words: Words) -> np.ndarray:
    """128 bits of each word."""
    out = np.empty(len(words.start), TERM)
    for name, seed in (("h", 0), ("check", 1)):
        out[name] = hash_spans(words.data, words.start, words.end, seed)
    return out


@dataclass
class Plan:
    """The sums of a block of items. Node i is term i, or for i >= len(terms) the sum of two nodes."""

    ids: list[int | None]
    terms: np.ndarray
    #: Nodes (left, right) by level; a level uses the nodes before it only.
    levels: list[tuple[np.ndarray, np.ndarray]]
    #: Nodes of all items, and where each item's begin. Every item has one at least.
    nodes: np.ndarray
    first: np.ndarray

    @property
    def size(self) -> int:
        return len(self.terms) + sum(len(left) for left, _ in self.levels)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """(item, document) sums of (term, document) values."""
        sums = np.empty((self.size, values.shape[1]), np.int64)
        at = len(values)
        sums[:at] = values
        for left, right in self.levels:
            np.add(sums[left], sums[right], out=sums[at : at + len(left)])
            at += len(left)
        return np.add.reduceat(sums[self.nodes], self.first, axis=0)


def share(items: list[np.ndarray], n_terms: int) -> tuple[list[list[tuple[int, int]]], list[list[int]]]:
    """Shared term sets of items (arrays of different term numbers): the nodes by level, and the
    nodes that are left of each item."""
    held = np.bincount(np.concatenate(items), minlength=n_terms)
    rows = [own[np.lexsort((own, -held[own]))].tolist() for own in items]
    levels, size = [], n_terms
    while True:
        pairs = Counter(p for row in rows for p in zip(row[:-1], row[1:], strict=True))
        joined, used = {}, set()
        for (a, b), times in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if times < 2:
                break
            # A node joins one other in a round, so the joins of a round don't overlap.
            if a not in used and b not in used:
                used |= {a, b}
                joined[a, b] = size + len(joined)
        if not joined:
            return levels, rows
        levels.append(list(joined))
        size += len(joined)
        new = []
        for row in rows:
            out, at = [], 0
            while at < len(row):
                pair = joined.get((row[at], row[at + 1])) if at + 1 < len(row) else None
                out.append(row[at] if pair is None else pair)
                at += 1 if pair is None else 2
            new.append(out)
        rows = new


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = terms_of(batch.column(1))
        all_terms = named(words)
        own = [np.unique(all_terms[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        yield pa.record_batch(
            [batch.column(0), pa.array([t.tobytes() for t in own], pa.binary()), pa.array([len(t) for t in own], pa.int64())],
            ["item_id", "terms", "n"],
        )


def _plan(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plan of a block of items."""
    items = [r for batch in batches for r in zip(batch.column("item_id").to_pylist(), batch.column("terms").to_pylist(), strict=True)]
    items.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    every = [np.frombuffer(t, TERM) for _, t in items]
    terms, number = np.unique(np.concatenate(every), return_inverse=True)
    cuts = np.cumsum([len(t) for t in every])[:-1]
    levels, rows = share(np.split(number, cuts), len(terms))
    plan = Plan([i for i, _ in items], terms, [tuple(np.array(level).T) for level in levels], np.concatenate(rows).astype(np.int64),
                np.cumsum([0, *map(len, rows)])[:-1])
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([pickle.dumps(plan)], pa.binary())], ["block", "plan"])


def plans(items: DataFrame) -> DataFrame:
    """(block, plan): the items, dealt into blocks of about ``BLOCK_TERMS`` terms."""
    whole = items.select(column("item_id").cast("long").alias("item_id"), column("text").cast("string").alias("text"))
    terms = written(whole.mapInArrow(_item_terms, "item_id long, terms binary, n long").where("n > 0"), "items")
    blocks = -(-(terms.agg(F.sum("n")).first()[0] or 0) // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(max(1, blocks)))
    return written(terms.withColumn("block", block).groupBy("block").applyInArrow(_plan, "block long, plan binary"), "plans")


def _postings(shared):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in slices(batches):
            words = terms_of(batch.column(1))
            at = np.minimum(np.searchsorted(terms["h"], hashes := words.hashes()), len(terms) - 1)
            hit = np.flatnonzero(terms["h"][at] == hashes)
            # The other 64 bits, of what the first ones found.
            hit = hit[hash_spans(words.data, words.start[hit], words.end[hit], 1) == terms["check"][at[hit]]]
            doc = np.searchsorted(words.first, hit, "right") - 1
            pair, tf = np.unique(doc * len(terms) + at[hit], return_counts=True)
            doc, term = pair // len(terms), (pair % len(terms)).astype("<i4")
            border = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            count = words.count
            some = np.flatnonzero(count)
            raw, often = term.tobytes(), tf.astype("<i4").tobytes()
            cut = [(4 * border[d], 4 * border[d + 1]) for d in some]
            yield pa.record_batch([
                batch.column(0).take(pa.array(some)), pa.array(count[some]),
                pa.array([raw[a:b] for a, b in cut], pa.binary()), pa.array([often[a:b] for a, b in cut], pa.binary()),
            ], ["doc_id", "n", "terms", "tf"])
    return rows


def _counts(size: int):
    """Documents that hold each term; -1: all documents, -2: all their terms."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4"), minlength=size)
            docs += batch.num_rows
            length += sum(batch.column(0).to_pylist())
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array([*some, -1, -2], pa.int64()), pa.array([*held[some], docs, length], pa.int64())], ["term", "n"])
    return rows


@dataclass
class _Best:
    """The best documents of each of some items so far."""

    items: int
    k: int

    def __post_init__(self):
        self.least = np.ones(self.items, np.int64)
        self.rows = np.zeros((0, 4), np.int64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.held.append(np.stack([item, scores[item, doc], missing[doc], ids[doc]], 1))
        self.size += len(item)
        if self.size > 4 * self.items * self.k + 4096:
            self.cut()

    def cut(self) -> None:
        """Keep k rows of each item: the highest scores, of equal ones the smallest ids, null last."""
        rows = np.concatenate([self.rows, *self.held])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], np.arange(self.items + 1))
        place = np.arange(len(rows)) - first[rows[:, 0]]
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.least[full] = rows[first[full] + self.k - 1, 1]
        self.rows, self.held, self.size = rows[place < self.k], [], 0


def _rank(shared, k: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, weight, n_docs, length = shared.value
        best = [_Best(len(plan.ids), k) for _, plan, _ in blocks]
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS):
                part = batch.slice(start, DOCS)
                n = np.array(part.column(1).to_pylist(), np.int64)
                term = np.frombuffer(b"".join(blobs := part.column(2).to_pylist()), "<i4")
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), "<i4").astype(np.int64)
                doc = np.repeat(np.arange(len(n)), [len(b) // 4 for b in blobs])
                # In Python's integers where 64 bits might not hold the product.
                exact = n.astype(object) if int(n.max()) * n_docs * 50 >= 1 << 63 else n
                m = 100 - 50 + (50 * exact * n_docs // length).astype(np.int64)
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                ids = part.column(0)
                missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                for (_, plan, place), own in zip(blocks, best, strict=True):
                    values = np.zeros((len(plan.terms), len(n)), np.int64)
                    row = place[term]
                    use = row >= 0
                    values[row[use], doc[use]] = value[use]
                    own.add(plan.scores(values), ids, missing)
        for (block, plan, _), own in zip(blocks, best, strict=True):
            own.cut()
            item, score, gone, doc = own.rows.T
            yield pa.record_batch([
                pa.array(np.full(len(item), block)), pa.array(item), pa.array([plan.ids[i] for i in item], pa.int64()),
                pa.array(doc, mask=gone.astype(bool)), pa.array(score),
            ], ["block", "place", "item_id", "doc_id", "score"])
    return rows


def _search(docs: DataFrame, group: list[tuple[int, Plan]], k: int) -> DataFrame:
    """(block, place, item_id, doc_id, score) of the best documents that each task found."""
    sc = docs.sparkSession.sparkContext
    terms = np.unique(np.concatenate([plan.terms for _, plan in group]))
    shared = sc.broadcast(terms)
    postings = written(docs.mapInArrow(_postings(shared), "doc_id long, n long, terms binary, tf binary"), "postings")
    counted = postings.select("n", "terms").mapInArrow(_counts(len(terms)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    held = {r["term"]: r["n"] for r in counted.collect()}
    n_docs, length = held.get(-1, 0), held.get(-2, 0)
    weight = np.zeros(len(terms), np.int64)
    for t, df in held.items():
        if t >= 0:
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    blocks = []
    for block, plan in group:
        place = np.full(len(terms), -1, np.int64)
        place[np.searchsorted(terms, plan.terms)] = np.arange(len(plan.terms))
        blocks.append((block, plan, place))
    ranked = postings.mapInArrow(
        _rank(sc.broadcast((blocks, weight, n_docs, length)), k), "block long, place long, item_id long, doc_id long, score long"
    )
    return written(ranked, "ranked")


def search(docs: DataFrame, items: DataFrame, *, k: int = BEST, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``k`` documents of highest score above 0.

    Equal scores are ranked by ascending doc_id, null last. Rows that repeat a doc_id, or have none,
    are documents of their own; rows that repeat an item_id, or have none, are items of their own.
    Null texts and texts without terms are never found, such items find nothing. Other columns are
    left behind.
    """
    spark = docs.sparkSession
    whole = documents(docs)
    found, group, size = [], [], 0
    for r in plans(items).toLocalIterator():
        if group and size + len(r["plan"]) > broadcast_bytes:
            found.append(_search(whole, group, k))
            group, size = [], 0
        group.append((r["block"], pickle.loads(r["plan"])))
        size += len(r["plan"])
    if group:
        found.append(_search(whole, group, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    item, order = ["block", "place"], [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = Window.partitionBy(*item, "part").orderBy(*order)
    rows = reduce(DataFrame.unionByName, found).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FIRST)))
    rows = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    last = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*item).orderBy(*order))).where(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")
