"""Vector codes by integer product quantisation, with LAESA pivots for the nearest entry.

Vectors become integers and are cut into equal consecutive parts; each part position has its own
codebook. A few entries of the first codebook that lie far apart are the pivots of a position. The
distances from every part to its pivots are computed once and stored with the parts. In each round
only the distances from the pivots to the codebook's entries are new: by the triangle inequality the
difference of two such distances bounds that from part to entry from below. Entries are tried in the
order of their bounds, by exact integer arithmetic, until the next bound is above the best distance.

Rounds are Spark jobs over the stored parts: a task sums the parts of each entry, Spark adds up the
tasks' sums, and only the codebook, of a size that no table changes, passes the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import column, written

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 8
#: Parts whose bounds are held at once, and entries tried at a time.
BLOCK, TRY = 4096, 8


def hold(dims: int) -> int:
    """Integers are held within this bound, so that no squared distance of whole vectors exceeds 63 bits."""
    return min((1 << 31) - 1, math.isqrt(((1 << 63) - 1) // max(1, dims)) // 2)


def to_parts(vectors: np.ndarray, parts: int = PARTS, scale: int = SCALE) -> np.ndarray:
    """(row, part, component) integers floor(scale * x); zeros fill the last part up."""
    n, dims = vectors.shape
    width = -(-dims // parts)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(vectors * float(scale)), -hold(width * parts), hold(width * parts)).astype(np.int64)
    out = np.zeros((n, parts * width), np.int64)
    out[:, :dims] = whole
    return out.reshape(n, parts, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the last axes."""
    step = a - b
    return (step * step).sum(-1)


def choose_pivots(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries of one codebook that lie far apart: each next one is farthest from those chosen."""
    chosen = [0]
    near = squared(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances, rounded to 24 bits, from each row to each pivot."""
    return np.sqrt(squared(rows[:, None], pivots[None]).astype(np.float64)).astype(np.float32)


def nearest(rows: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row the nearest entry (ties: the first), its squared distance, and how many distances that took."""
    index, error, tried = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), 0
    entry_pivot = to_pivots(entries, pivots)
    for a in range(0, len(rows), BLOCK):
        own, far = rows[a : a + BLOCK], to_pivot[a : a + BLOCK]
        bound = np.zeros((len(own), len(entries)), np.float32)
        for p in range(len(pivots)):
            x, y = far[:, p, None], entry_pivot[None, :, p]
            # What rounding may have added is taken off again.
            np.maximum(bound, np.abs(x - y) - (x + y) * np.float32(2**-21), out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        least = np.take_along_axis(bound, order, 1).astype(np.float64) ** 2 * (1 - 1e-6)
        best = np.full(len(own), np.iinfo(np.int64).max)
        which = np.full(len(own), len(entries))
        active = np.arange(len(own))
        for k in range(0, len(entries), TRY):
            active = active[least[active, k] <= best[active]]
            if not len(active):
                break
            some = order[active, k : k + TRY]
            d = squared(own[active, None], entries[some])
            tried += d.size
            # Of equal distances the smaller index wins, whatever order they were tried in.
            first = np.lexsort((some, d), axis=1)[:, :1]
            d, some = np.take_along_axis(d, first, 1)[:, 0], np.take_along_axis(some, first, 1)[:, 0]
            better = (d < best[active]) | ((d == best[active]) & (some < which[active]))
            best[active[better]], which[active[better]] = d[better], some[better]
        index[a : a + BLOCK], error[a : a + BLOCK] = which, best
    return index, error, tried


@dataclass
class Codebooks:
    """Entries of each part position (position, entry, component), and the pivots of each."""

    entries: np.ndarray
    pivots: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _stored(batch: pa.RecordBatch, parts: int, width: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(batch.column("parts").to_pylist()), "<i4").astype(np.int64)
    far = np.frombuffer(b"".join(batch.column("far").to_pylist()), "<f4")
    return flat.reshape(-1, parts, width), far.reshape(-1, parts, pivots)


def _measure(books: Codebooks, dims: int, scale: int):
    parts = len(books.pivots)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            cut = to_parts(flat.reshape(-1, dims), parts, scale)
            far = np.stack([to_pivots(cut[:, p], books.pivots[p]) for p in range(parts)], 1)
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array([r.astype("<i4").tobytes() for r in cut], pa.binary()),
                pa.array([r.astype("<f4").tobytes() for r in far], pa.binary()),
            ], ["vec_id", "label", "parts", "far"])
    return rows


def _sum_parts(books: Codebooks):
    parts, size, width = books.entries.shape

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cut, far = _stored(batch, parts, width, len(books.pivots[0]))
            for p in range(parts):
                index, _, _ = nearest(cut[:, p], far[:, p], books.entries[p], books.pivots[p])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                total[p, used] += np.add.reduceat(cut[order, p], first, axis=0)
                count[p] += np.bincount(index, minlength=size)
        part, entry = np.nonzero(count)
        yield pa.record_batch([
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
            pa.array(list(total[part, entry]), pa.list_(pa.int64())),
        ], ["part", "entry", "n", "total"])
    return rows


def _code(books: Codebooks):
    parts, _, width = books.entries.shape

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cut, far = _stored(batch, parts, width, len(books.pivots[0]))
            done = [nearest(cut[:, p], far[:, p], books.entries[p], books.pivots[p]) for p in range(parts)]
            codes = np.stack([index for index, _, _ in done], 1).tolist()
            yield pa.record_batch([
                batch.column("vec_id"), batch.column("label"), pa.array(["".join(f"{i:02x}" for i in c) for c in codes], pa.string()),
                pa.array(np.sum([error for _, error, _ in done], axis=0)),
            ], ["vec_id", "label", "code", "error"])
    return rows


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, v) of rows whose vector has only finite components, and the length of the vectors."""
    whole = vectors.select(
        column("vec_id").cast("long").alias("vec_id"), column("label").alias("label"), column("embedding").cast("array<double>").alias("v")
    ).where("v is not null and size(v) > 0").where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    sizes = whole.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = sizes[0]["dims"] if sizes else 0
    return whole.where(F.size("v") == dims), dims


def train(points: DataFrame, start: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after so many rounds over the measured points."""
    books = start
    width = books.entries.shape[2]
    for _ in range(rounds):
        sums = points.mapInArrow(_sum_parts(books), "part int, entry int, n long, total array<long>")
        means = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)))
        entries = books.entries.copy()
        for r in means.collect():
            entries[r["part"], r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(width)]
        books = Codebooks(entries, books.pivots)
    return books


def compress(
    vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256, label) of every usable row.

    ``vectors`` has vec_id, embedding and label; other columns are left behind. Rows whose vector is
    null, empty, or holds null or non-finite components are dropped, and rows whose vector's length
    isn't that of most rows (of equally many, the longer). A length that the parts do not divide is
    filled up with zeros. Components beyond ``hold(dims)`` are held there. With fewer rows than
    ``entries`` the codebooks have that many. Rows that repeat a vec_id, or have none, are coded
    apart; for the first codebook they come by vector, rows without an id last. ``label_error``
    is null where the sum exceeds a long.
    """
    spark = vectors.sparkSession
    whole, dims = usable(vectors)
    kind = dict(whole.dtypes)["label"]
    if not dims:
        return spark.createDataFrame([], f"vec_id long, code string, error long, label_error long, codebooks_sha256 string, label {kind}")
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.swapaxes(to_parts(np.array([r["v"] for r in first], np.float64), parts, scale), 0, 1)
    books = Codebooks(start, [choose_pivots(own, pivots) for own in start])
    points = written(
        whole.mapInArrow(_measure(books, dims, scale), f"vec_id long, label {kind}, parts binary, far binary"), "vectors"
    )
    books = train(points, books, rounds)
    coded = written(points.mapInArrow(_code(books), f"vec_id long, label {kind}, code string, error long"), "codes")
    total = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(total, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"), "label"
    )
