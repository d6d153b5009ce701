"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item of 30 words inside a document of 20,000 has a Jaccard similarity near zero, so a MinHash
of the document would never meet that of the item. The search is therefore asymmetric. Items are
partitioned by size (powers of two of their shingle count). Each partition has its own number of
MinHash functions: the sketch of an item is the set of its shingles that are smallest under those
functions. A document that contains a share t of an item contains each sketch shingle with
probability t, so it misses all of m distinct ones with (1 - t)^m. Partitions of short items, whose
m would exceed the size, keep every shingle; there nothing can be missed. Documents probe with every
shingle of their whole text. Candidates are verified by the exact share of the item's shingles.

Probing and verifying are one pass over the documents, in the task that reads them: the items travel,
in groups of a bounded size, and no shingle of a document does. An item of fewer words than a shingle
has one, its own words; documents probe with that many words too, if there are such items.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import column, documents, map_rows, written
from tickloom.llm.text import Words, grams, inside, mix, slices

#: Words of a shingle, and the share of an item's shingles that makes a document contaminated.
SHINGLE, SHARE = 5, 0.8
#: Chance that a candidate at the threshold may be missed.
MISS = 1e-9
#: Bytes of item shingles in a broadcast; more items are searched for in several passes.
BROADCAST = 64 << 20


def sketch_size(size: int, share: float = SHARE, miss: float = MISS) -> int:
    """MinHash shingles kept for items of the partition that ``size`` (shingles) falls in; size itself if few."""
    need = int(np.ceil(np.log(miss) / np.log(1 - share))) if share < 1 else 1
    lower = 1 << max(0, int(size).bit_length() - 1)
    return size if lower <= 2 * need else min(size, need)


def _shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each k words in a row of one text."""
    hashes = grams(words.hashes(), k)
    ok = inside(words.first, len(hashes), k)
    return words.doc[: len(hashes)][ok], hashes[ok]


def sketch(own: np.ndarray, share: float) -> np.ndarray:
    """Which of an item's different shingles are in its sketch."""
    m = sketch_size(len(own), share)
    chosen = np.zeros(len(own), bool)
    if m == len(own):
        chosen[:] = True
    # One function after another, until m different shingles are smallest.
    f = 0
    while chosen.sum() < m:
        rank = mix(own ^ mix(np.array([f + 1], np.uint64)))
        rank[chosen] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen[rank.argmin()] = True
        f += 1
    return chosen


def _item_rows(k: int, share: float):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words.of(batch.column(1))
            count = words.count
            found = [(k, *_shingles(words, k))]
            found += [(n, *(x[np.isin(doc, np.flatnonzero(count == n))] for x in (doc, hashes)))
                      for n in range(1, k) for doc, hashes in [_shingles(words, n)]]
            ids, out = batch.column(0).to_pylist(), []
            for length, doc, hashes in found:
                for i in np.unique(doc):
                    own = np.unique(hashes[doc == i])
                    out.append((ids[i], length, own.tobytes(), np.packbits(sketch(own, share)).tobytes()))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["item_id", "words", "shingles", "probes"])
    return rows


@dataclass
class Items:
    """Some items by their shingles: the hashes in order, the items of each, and which of them probe."""

    ids: list[int | None]
    size: np.ndarray
    lengths: list[int]
    keys: np.ndarray
    probes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    share: float

    @classmethod
    def of(cls, rows: list, share: float) -> Items:
        own = [np.frombuffer(r["shingles"], "<u8") for r in rows]
        marks = [np.unpackbits(np.frombuffer(r["probes"], np.uint8))[: len(o)].astype(bool) for r, o in zip(rows, own, strict=True)]
        item, flat, mark = np.repeat(np.arange(len(rows)), [len(o) for o in own]), np.concatenate(own), np.concatenate(marks)
        order = np.argsort(flat, kind="stable")
        flat, item, mark = flat[order], item[order], mark[order]
        keys, first = np.unique(flat, return_index=True)
        return cls([r["item_id"] for r in rows], np.array([len(o) for o in own]), sorted({r["words"] for r in rows}), keys,
                   np.logical_or.reduceat(mark, first), np.append(first, len(flat)), item, share)

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, shared shingles) where a text contains the share of an item."""
        words = Words.of(texts)
        pairs = []
        for k in self.lengths:
            doc, hashes = _shingles(words, k)
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            pairs.append(np.unique(doc[hit] * len(self.keys) + at[hit]))
        pair = np.unique(np.concatenate(pairs))
        doc, at = pair // len(self.keys), pair % len(self.keys)
        # Of the texts that no sketch has met, nothing is verified.
        near = np.isin(doc, np.unique(doc[self.probes[at]]))
        doc, at = doc[near], at[near]
        times = self.first[at + 1] - self.first[at]
        where = np.repeat(self.first[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        both, shared = np.unique(np.repeat(doc, times) * len(self.ids) + self.item[where], return_counts=True)
        doc, item = both // len(self.ids), both % len(self.ids)
        enough = shared >= self.share * self.size[item] - 1e-9
        return doc[enough], item[enough], shared[enough]


def groups(items: DataFrame, k: int, share: float, broadcast_bytes: int) -> Iterator[Broadcast]:
    """The items as broadcasts of at most that many bytes each, or of one item."""
    spark = items.sparkSession
    table = written(
        items.select(column("item_id").cast("long").alias("item_id"), column("text").cast("string").alias("text"))
        .mapInArrow(_item_rows(k, share), "item_id long, words int, shingles binary, probes binary"), "items"
    )
    rows, size = [], 0
    for r in table.toLocalIterator():
        own = 4 * len(r["shingles"])
        if rows and size + own > broadcast_bytes:
            yield spark.sparkContext.broadcast(Items.of(rows, share))
            rows, size = [], 0
        rows.append(r)
        size += own
    if rows:
        yield spark.sparkContext.broadcast(Items.of(rows, share))


FOUND = "doc_id long, item_id long, n_shared long, n_item long"


def _found(shared: Broadcast):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in slices(batches):
            doc, item, n = items.find(batch.column(1))
            if len(doc):
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(doc)), pa.array([items.ids[i] for i in item], pa.int64()), pa.array(n), pa.array(items.size[item])],
                    ["doc_id", "item_id", "n_shared", "n_item"],
                )
    return rows


def contained_items(
    docs: DataFrame, items: DataFrame, *, k: int = SHINGLE, share: float = SHARE, broadcast_bytes: int = BROADCAST
) -> DataFrame:
    """Items found in documents: (doc_id, item_id, n_shared, n_item, containment), containment >= share.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are left behind. A null or
    empty text has no shingles: such items are never found and such documents never match. An item of
    one to ``k - 1`` words is one shingle of that many words. Items of one text are all reported. Rows
    that repeat a doc_id are judged apart and a pair is reported once, with its best row; a null doc_id
    is an id like any other.
    """
    whole = documents(docs)
    found = [whole.mapInArrow(_found(g), FOUND) for g in groups(items, k, share, broadcast_bytes)]
    if not found:
        return docs.sparkSession.createDataFrame([], f"{FOUND}, containment double")
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("best"))
        .select("doc_id", "item_id", "best.n_shared", "best.n_item", "best.containment")
    )


def remove_contaminated(
    docs: DataFrame, items: DataFrame, *, k: int = SHINGLE, share: float = SHARE, broadcast_bytes: int = BROADCAST
) -> DataFrame:
    """Rows whose text contains no item; columns unchanged. Each row is judged by its own text, whatever
    its id; a row without a text stays."""
    text = docs.columns.index("text")

    def clean(shared: Broadcast):
        def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, batches_text):
                keep = np.ones(batch.num_rows, bool)
                keep[shared.value.find(batch.column(text))[0]] = False
                yield batch.filter(pa.array(keep))
        return rows

    batches_text = str(text)
    for group in groups(items, k, share, broadcast_bytes):
        docs = map_rows(docs, clean(group))
    return docs
