"""N-gram Jaccard join by chosen paths.

Sets of word shingles are split again and again on sampled shared tokens: a coordinate of a MinHash
sketch names one shingle of each set, and sets that name the same one go on together. A pair of
similarity s stays together with probability s at each coordinate. Buckets of at most ``LEAF`` sets
are compared by brute force; larger ones are split on. Each run picks 1/threshold coordinates on
average at each split (the expected branching of the chosen-path method). As many runs are made as
the target recall asks for at the threshold in buckets that are split to the last, and each run
begins with coordinates of its own. A bucket that is too large after the first split is split in two
ways.

A leaf is compared in two steps. All sketches of it are compared; a pair whose share of equal
coordinates is far below the threshold goes no further, which counts in the recall. The sets that are
left with a partner are compared by their exact shingles.

Near copies of one text would stay together however often they are split. Distance, 1 - similarity,
is a metric: sets within half the largest linked distance of one centre are all linked to each other.
The centre of a large bucket is the set of the shingles that most of some of its members hold; what
lies so near to it is a clique. A clique is counted, not listed, and buckets of one clique end. Where
a bucket is mostly one clique, only its other sets are compared, with the clique and each other.
Buckets that splitting does not shrink for other reasons are compared in tiles, so no bucket is
dropped or cut.

Documents of one shingle set are one representative with a number and a weight, so copies never meet.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import documents, small_enough, union_find, written
from tickloom.llm.text import Words, grams, inside, mix, slices

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Coordinates of a sketch; most sets of a bucket that are compared at once; splits of one path.
SKETCH, LEAF, DEPTH = 64, 4096, 5
#: Shingles that are compared exactly at once; larger leaves are compared in blocks.
SHINGLES = 4_000_000
#: Sets of a bucket that may hold a clique, and members that its centre is made from.
CLIQUE, SAMPLE = 64, 16
#: Chance that a pair at the threshold has too few equal coordinates to be looked at.
UNSEEN = 1e-4

_RNG = np.random.default_rng(7)
_SEEDS = _RNG.integers(1, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)


def least_equal(threshold: float, unseen: float = UNSEEN) -> int:
    """Equal coordinates of pairs that are compared exactly: fewer have that chance at the threshold."""
    below = 0.0
    for equal in range(SKETCH + 1):
        below += math.comb(SKETCH, equal) * threshold**equal * (1 - threshold) ** (SKETCH - equal)
        if below > unseen:
            return equal
    return SKETCH


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold has been in one leaf with that probability, however
    often its buckets are split: DEPTH + 1 times, of which the second is made twice.

    All runs draw from one sketch, so the pair's share of equal coordinates, which varies by chance,
    holds for all of them: the chance to miss is the mean over that share. Pairs with too few equal
    coordinates are always missed.
    """
    more = 1 / threshold - 1
    chance, together = [], []
    unseen = sum(math.comb(SKETCH, n) * threshold**n * (1 - threshold) ** (SKETCH - n) for n in range(least_equal(threshold)))
    if unseen >= 1 - recall:
        raise ValueError(f"a recall above {1 - unseen} needs longer sketches")
    for equal in range(least_equal(threshold), SKETCH + 1):
        chance.append(math.comb(SKETCH, equal) * threshold**equal * (1 - threshold) ** (SKETCH - equal))
        stays = 1.0
        for depth in range(DEPTH, -1, -1):
            if depth == 0:
                stays = 1 - (1 - stays) ** 2
            miss = 1 - equal / SKETCH * stays
            stays = 1 - ((1 - more) * miss + more * miss**2)
        together.append(stays)
    runs = 1
    while unseen + sum(c * (1 - t) ** runs for c, t in zip(chance, together, strict=True)) > 1 - recall:
        runs += 1
    return runs


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, text by text, and where each text's begin. A text of fewer
    than k words, but one at least, has one shingle: all its words."""
    words = Words.of(texts)
    own = words.hashes()
    hashes = grams(own, k)
    ok = inside(words.first, len(hashes), k)
    doc = words.doc
    docs, values = [doc[: len(hashes)][ok]], [hashes[ok]]
    count = words.count
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            docs.append(short)
            values.append(grams(own, n)[words.first[short]])
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[fresh], value[fresh]
    return value, np.searchsorted(doc, np.arange(len(count) + 1))


def _keys(value: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits that name each set; None for an empty one."""
    full = np.flatnonzero(np.diff(at))
    sums = np.zeros((len(at) - 1, 2), np.uint64)
    if len(full):
        for side, salt in enumerate((0x51ED270B, 0x2545F491)):
            sums[full, side] = np.add.reduceat(mix(value ^ mix(np.array([salt], np.uint64))), at[:-1][full])
    sums += np.diff(at).astype(np.uint64)[:, None]
    some = np.diff(at) > 0
    return [row.tobytes() if ok else None for row, ok in zip(sums, some, strict=True)]


def _sketches(k: int):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            value, at = shingle_sets(batch.column(1), k)
            full = np.flatnonzero(np.diff(at))
            sketch = np.zeros((len(at) - 1, SKETCH), "<u4")
            if len(full):
                starts = at[:-1][full]
                for i, seed in enumerate(_SEEDS):
                    sketch[full, i] = np.minimum.reduceat((value * seed) >> np.uint64(32), starts)
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(_keys(value, at), pa.binary()), pa.array([r.tobytes() for r in sketch], pa.binary())],
                ["doc_id", "text_hash", "key", "sketch"],
            )
    return rows


def _shingles(k: int):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            value, at = shingle_sets(batch.column(1), k)
            raw = value.tobytes()
            yield pa.record_batch(
                [pa.array(_keys(value, at), pa.binary()),
                 pa.array([raw[8 * a : 8 * b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                ["key", "shingles"],
            )
    return rows


def similar(sets: list[np.ndarray], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the others with that Jaccard similarity at least, by exact intersection sizes."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    row = np.repeat(np.arange(m), size.astype(np.int64))
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    number = np.cumsum(shared) - 1
    use = shared[place]
    row, col = row[use], number[place[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((m, m), np.float32)
    total = int(shared.sum())
    for start in range(0, total, 2048):
        width = min(2048, total - start)
        a, b = np.searchsorted(col, [start, start + width])
        part = np.zeros((m, width), np.float32)
        part[row[a:b], col[a:b] - start] = 1
        both += part @ part.T
    for i in range(m):
        near = both[i] >= threshold * (size[i] + size - both[i]) - 1e-6
        near[i] = False
        if near.any():
            yield i, np.flatnonzero(near)


def _blocks(sets: list[np.ndarray]) -> list[list[int]]:
    """Places of the sets, in blocks of at most half of ``SHINGLES`` shingles, or of one set."""
    out, size = [[]], 0
    for i, own in enumerate(sets):
        if out[-1] and size + len(own) > SHINGLES // 2:
            out.append([])
            size = 0
        out[-1].append(i)
        size += len(own)
    return out


def linked(sets: list[np.ndarray], cliques: np.ndarray, threshold: float) -> list[np.ndarray]:
    """For each set the others that are similar and not of its clique."""
    near: list[list[np.ndarray]] = [[] for _ in sets]
    blocks = _blocks(sets)
    for a in range(len(blocks)):
        for b in range(a, len(blocks)):
            both = blocks[a] + (blocks[b] if b > a else [])
            place = np.array(both)
            for i, others in similar([sets[x] for x in both], threshold):
                if b > a:
                    others = others[(others >= len(blocks[a])) != (i >= len(blocks[a]))]
                others = place[others]
                near[both[i]].append(others[cliques[others] != cliques[both[i]]])
    return [np.concatenate(n) if n else np.zeros(0, np.int64) for n in near]


def _groups(batches: Iterable[pa.RecordBatch], held: int) -> Iterator[tuple[int, list[list]]]:
    """Rows (leaf, ...) in leaf order, leaf by leaf: the leaf and its ``held`` other columns."""
    now, rest = None, [[] for _ in range(held)]
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(ids)] if len(ids) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if ids[a] != now:
                if now is not None:
                    yield now, rest
                now, rest = ids[a], [[] for _ in range(held)]
            for have, i in zip(rest, range(1, held + 1), strict=True):
                have.extend(batch.column(i).slice(a, b - a).to_pylist())
    if now is not None:
        yield now, rest


def _candidates(least: int):
    """Rows (leaf, id, clique, sketch) in leaf order: the sets that share so many coordinates with one of
    another clique."""

    def rows(batches: Iterable[pa.RecordBatch]):
        out, size = [], 0
        for leaf, (ids, cliques, sketches) in _groups(batches, 3):
            ids, cliques = np.array(ids, np.int64), np.array(cliques, np.int64)
            sketch = np.frombuffer(b"".join(sketches), "<u4").reshape(len(ids), SKETCH)
            if len(ids) == 2:
                some = np.full(2, cliques[0] != cliques[1] and (sketch[0] == sketch[1]).sum() >= least)
            else:
                some = _with_partner(sketch, cliques, least)
            if some.any():
                out.append((np.full(some.sum(), leaf), ids[some]))
                size += len(out[-1][1])
            if size > 1 << 16:
                yield _leaf_rows(out)
                out, size = [], 0
        if out:
            yield _leaf_rows(out)
    return rows


def _with_partner(sketch: np.ndarray, cliques: np.ndarray, least: int, width: int = 256) -> np.ndarray:
    """Which sets share enough coordinates with a set of another clique; some rows at a time."""
    n = len(sketch)
    some, columns = np.zeros(n, bool), np.ascontiguousarray(sketch.T)
    for a in range(0, n, width):
        equal = np.zeros((min(width, n - a), n), np.uint8)
        for own in columns:
            equal += own[a : a + width, None] == own[None, :]
        some[a : a + width] |= ((equal >= least) & (cliques[a : a + width, None] != cliques[None])).any(1)
    return some


def _leaf_rows(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    leaf, ids = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.record_batch([pa.array(leaf), pa.array(ids)], ["leaf", "id"])


#: A partner of a set: its number, and how many documents it stands for.
PARTNER = np.dtype([("id", "<i8"), ("weight", "<i8")])


def _compare(threshold: float):
    """Rows (leaf, id, clique, weight, shingles) in leaf order: each set's partners, and one of them as an edge."""

    def rows(batches: Iterable[pa.RecordBatch]):
        for _, (ids, cliques, weights, blobs) in _groups(batches, 4):
            near = linked([np.frombuffer(b, "<u8") for b in blobs], np.array(cliques, np.int64), threshold)
            some = [i for i, own in enumerate(near) if len(own)]
            if not some:
                continue
            about = np.array(list(zip(ids, weights, strict=True)), PARTNER)
            root = list(range(len(ids)))

            def find(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i in some:
                for j in near[i]:
                    a, b = sorted((find(i), find(int(j))))
                    root[b] = a
            yield pa.record_batch([
                pa.array([ids[i] for i in some], pa.int64()), pa.array([ids[find(i)] for i in some], pa.int64()),
                pa.array([about[near[i]].tobytes() for i in some], pa.binary()),
            ], ["id", "root", "partners"])
    return rows


def _count_links(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Documents behind the distinct partners of each set."""
    for batch in batches:
        total = []
        for lists in batch.column(1).to_pylist():
            partners = np.frombuffer(b"".join(lists), PARTNER)
            total.append(int(partners["weight"][np.unique(partners["id"], return_index=True)[1]].sum()))
        yield pa.record_batch([batch.column(0), pa.array(total, pa.int64())], ["id", "linked"])


def _step(path: np.ndarray, sketch: np.ndarray, coordinate: np.ndarray) -> np.ndarray:
    value = np.take_along_axis(sketch, coordinate[:, None], 1)[:, 0].astype(np.uint64)
    return mix(mix(path ^ mix(coordinate.astype(np.uint64) + np.uint64(1))) ^ value)


def _salted(path: np.ndarray, salt: int) -> np.ndarray:
    return mix(path ^ np.uint64(0x9E3779B97F4A7C15 * salt % (1 << 64)))


def next_paths(path: np.ndarray, sketch: np.ndarray, threshold: float, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The paths on which sets go on, and whose they are: one for each chosen coordinate, 1/threshold
    on average. The coordinates follow from the path, or are ``first`` and the next one."""
    more = np.flatnonzero((_salted(path, 1) >> np.uint64(11)).astype(np.float64) / (1 << 53) < 1 / threshold - 1)
    if first is None:
        one = (_salted(path, 2) % np.uint64(SKETCH)).astype(np.int64)
        # Never the same one twice.
        step = (_salted(path, 3) % np.uint64(SKETCH - 1)).astype(np.int64) + 1
    else:
        one, step = np.full(len(path), first % SKETCH), np.ones(len(path), np.int64)
    other = ((one + step) % SKETCH)[more]
    return (np.concatenate((_step(path, sketch, one), _step(path[more], sketch[more], other))),
            np.concatenate((np.arange(len(path)), more)))


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), SKETCH)


def _first_paths(runs: int, threshold: float, seed: int):
    """Run r begins with the coordinates 2r and 2r + 1, so no two runs share one up to SKETCH / 2 runs."""

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            sketch, ids = _sketch_rows(batch.column(1)), batch.column(0).to_numpy()
            for r in range(runs):
                start = np.full(len(ids), mix(np.array([seed * 1_000_003 + r], np.uint64))[0])
                path, who = next_paths(start, sketch, threshold, 2 * r)
                yield pa.record_batch([pa.array(path.view(np.int64)), pa.array(ids[who])], ["path", "id"])
    return rows


def _more_paths(threshold: float, twice: bool):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            path, sketch = batch.column(0).to_numpy().view(np.uint64), _sketch_rows(batch.column(2))
            for start in (path, _salted(path, 4)) if twice else (path,):
                new, who = next_paths(start, sketch, threshold)
                yield pa.record_batch([pa.array(new.view(np.int64)), batch.column(1).take(pa.array(who))], ["path", "id"])
    return rows


def fetch(docs: DataFrame, reps: DataFrame, need: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of the representatives that ``need`` (id) names, from the documents' texts."""
    wanted = written(reps.select("id", "key", "doc_id").join(need.distinct(), "id", "left_semi"), "wanted")
    # Few ids go to the texts; texts go to the ids only where those are too many for a broadcast.
    ids = small_enough(wanted.select(F.col("doc_id").alias("_id")).distinct(), 16)
    shingles = (
        docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        .select("doc_id", "text").mapInArrow(_shingles(k), "key binary, shingles binary").where("key is not null")
    )
    # Other documents of one id may have other texts, and some of them the same one.
    own = small_enough(wanted.select("id", "key"), 40)
    return shingles.join(own, "key").groupBy("id").agg(F.first("shingles").alias("shingles"))


def _centres(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of the shingles that more than half of some members of a bucket hold."""
    sets = [np.frombuffer(b, "<u8") for batch in batches for b in batch.column("shingles").to_pylist()]
    values, times = np.unique(np.concatenate(sets), return_counts=True)
    most = values[2 * times > len(sets)]
    if len(most):
        name = int(np.bitwise_xor.reduce(mix(most)).view(np.int64))
        sketch = np.array([((most * seed) >> np.uint64(32)).min() for seed in _SEEDS], "<u4")
        yield pa.record_batch(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([name], pa.int64()), pa.array([most.tobytes()], pa.binary()), pa.array([sketch.tobytes()], pa.binary())],
            ["path", "centre", "centre_shingles", "centre_sketch"],
        )


def _may_be_near(least: int):
    """Rows (id, centre, sketch, centre_sketch) with so many equal coordinates."""
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            near = (_sketch_rows(batch.column(2)) == _sketch_rows(batch.column(3))).sum(1) >= least
            yield pa.record_batch([batch.column(i).filter(pa.array(near, pa.bool_())) for i in (0, 1)], ["id", "centre"])
    return rows


def _within(least: float):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            near = []
            for own, centre in zip(batch.column("shingles").to_pylist(), batch.column("centre_shingles").to_pylist(), strict=True):
                a, b = np.frombuffer(own, "<u8"), np.frombuffer(centre, "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(both >= least * (len(a) + len(b) - both) - 1e-9)
            yield pa.record_batch([batch.column("id").filter(pa.array(near, pa.bool_())), batch.column("centre").filter(pa.array(near, pa.bool_()))], ["id", "centre"])
    return rows


def find_cliques(docs: DataFrame, reps: DataFrame, big: DataFrame, k: int, threshold: float) -> DataFrame:
    """(id, clique) of sets that lie within half the largest linked distance of the centre of one of
    the buckets ``big`` (path, id); a clique is named by its smallest id. A set is in one clique at most."""
    order = Window.partitionBy("path").orderBy(F.xxhash64("id"), "id")
    some = big.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE).select("path", "id")
    held = fetch(docs, reps, some.select("id"), k)
    centres = written(
        some.join(held, "id").select("path", "shingles").groupBy("path").applyInArrow(_centres, "path long, centre long, centre_shingles binary, centre_sketch binary"), "centres"
    )
    once = centres.groupBy("centre").agg(F.first(F.struct("centre_shingles", "centre_sketch")).alias("own")).select("centre", "own.*")
    least = (1 + threshold) / 2
    may = written(
        big.join(centres.select("path", "centre"), "path").select("id", "centre").distinct().join(reps.select("id", "sketch"), "id")
        .join(once.select("centre", "centre_sketch"), "centre").select("id", "centre", "sketch", "centre_sketch")
        .mapInArrow(_may_be_near(least_equal(least)), "id long, centre long"), "near_centres"
    )
    inside_of = (
        may.join(fetch(docs, reps, may.select("id"), k), "id").join(once, "centre")
        .select("id", "shingles", "centre", "centre_shingles").mapInArrow(_within(least), "id long, centre long")
    )
    own = inside_of.groupBy("id").agg(F.min("centre").alias("centre"))
    named = written(own, "cliques")
    names = named.groupBy("centre").agg(F.min("id").alias("clique"), F.count("*").alias("n")).where("n > 1")
    return named.join(names, "centre").select("id", "clique")


def leaves(docs: DataFrame, reps: DataFrame, k: int, threshold: float, recall: float, seed: int = 1) -> tuple[DataFrame, DataFrame | None]:
    """Buckets to compare by brute force: rows (leaf, id, clique), each bucket once. A set of no
    clique is one of its own, named by its id. And the cliques (id, clique), or None."""
    paths = written(reps.select("id", "sketch").mapInArrow(_first_paths(runs_for(recall, threshold), threshold, seed), "path long, id long"), "paths")
    done, cliques = [], None
    for depth in range(DEPTH + 1):
        counts = paths.groupBy("path").agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
        ).where("n > 1")
        kept = written(paths.join(counts, "path"), "buckets")
        if depth == 0:
            large = kept.where(F.col("n") > CLIQUE).select("path", "id")
            if large.limit(1).count():
                cliques = written(find_cliques(docs, reps, large, k, threshold), "members")
        if cliques is None:
            kept = kept.withColumn("clique", F.col("id"))
        else:
            kept = kept.join(small_enough(cliques, 16), "id", "left").withColumn("clique", F.coalesce("clique", "id"))
        # A bucket's largest clique, and how many sets are not of it.
        by_clique = kept.where(F.col("n") > 2).groupBy("path", "clique").agg(F.count("*").alias("own"), F.first("n").alias("n"))
        main = by_clique.groupBy("path").agg(F.max(F.struct("own", "clique")).alias("main"), F.first("n").alias("n"))
        main = main.where("main.own > 1").select("path", F.col("main.clique").alias("main"), (F.col("n") - F.col("main.own")).alias("others"))
        told = kept.join(main, "path", "left").withColumn("others", F.coalesce("others", "n")).where("others > 0")
        told = written(told, "told")
        ready = F.col("others") <= LEAF
        last = depth == DEPTH
        done.append(_tiles(told if last else told.where(ready)))
        rest = told.where(~ready)
        if last or not rest.limit(1).count():
            break
        paths = written(
            rest.select("path", "id").join(reps.select("id", "sketch"), "id").select("path", "id", "sketch")
            .mapInArrow(_more_paths(threshold, depth == 0), "path long, id long"), "paths"
        )
    rows = reduce(DataFrame.unionByName, done)
    # Runs often end in the same bucket; one of them is enough.
    once = rows.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path").distinct()
    return rows.join(once, "path", "left_semi").select(F.col("leaf"), "id", "clique"), cliques


def _tiles(rows: DataFrame) -> DataFrame:
    """Buckets as leaves. The sets that are not of the main clique meet each other, in chunks, and each
    chunk of the main clique; chunks of it don't meet. A bucket of one chunk of either is one leaf."""
    own = F.col("clique").eqNullSafe(F.col("main"))
    chunks = F.ceil(F.col("others") / LEAF).cast("int")
    main_chunks = F.ceil((F.col("n") - F.col("others")) / LEAF).cast("int")
    mine = F.pmod(F.xxhash64("id", F.lit("tile")), F.when(own, main_chunks).otherwise(chunks)).cast("int")
    every = F.sequence(F.lit(0), chunks - 1)
    # Numbers of chunks: others from 0, the main clique's from -1 downwards.
    with_main = F.when(main_chunks > 0, F.sequence(F.lit(-1), -main_chunks, F.lit(-1))).otherwise(F.array().cast("array<int>"))
    one = (chunks == 1) & (main_chunks <= 1)
    meets = F.when(one, F.array(F.lit(0))).when(own, every).otherwise(F.concat(every, with_main))
    me = F.when(own & ~one, -mine - 1).otherwise(F.when(one, F.lit(0)).otherwise(mine))
    return (
        rows.select("path", "id", "clique", "n", "x", "y", me.alias("me"), F.explode(meets).alias("other"))
        .withColumn("leaf", F.xxhash64("path", F.least("me", "other"), F.greatest("me", "other"))).drop("me", "other")
    )


def represent(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts (doc_id, text); a row (id, key, doc_id, weight, sketch) for each set of shingles; and
    (doc_id, text_hash, key, sketch) of every row, key null without words."""
    whole = documents(docs)
    sets = written(
        whole.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        .mapInArrow(_sketches(k), "doc_id long, text_hash long, key binary, sketch binary"), "sets"
    )
    reps = written(
        sets.where("key is not null").groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("weight"), F.first("sketch").alias("sketch"))
        .withColumn("id", F.monotonically_increasing_id()), "representatives",
    )
    return whole, reps, sets


def _classes(docs: DataFrame, k: int, threshold: float, recall: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, key) of every row; and (key, class_id, n_links, root) of every set."""
    whole, reps, sets = represent(docs, k)
    rows, cliques = leaves(whole, reps, k, threshold, recall, seed)
    rows = written(rows, "leaves")
    need = written(
        rows.join(reps.select("id", "sketch"), "id").select("leaf", "id", "clique", "sketch")
        .repartition("leaf").sortWithinPartitions("leaf").mapInArrow(_candidates(least_equal(threshold)), "leaf long, id long"), "candidates"
    )
    compared = need.join(fetch(whole, reps, need.select("id"), k), "id").join(reps.select("id", "weight"), "id")
    if cliques is None:
        compared = compared.withColumn("clique", F.col("id"))
    else:
        compared = compared.join(small_enough(cliques, 16), "id", "left").withColumn("clique", F.coalesce("clique", "id"))
    compared = written(
        compared.select("leaf", "id", "clique", "weight", "shingles").repartition("leaf").sortWithinPartitions("leaf")
        .mapInArrow(_compare(threshold), "id long, root long, partners binary"), "compared"
    )
    links = compared.groupBy("id").agg(F.collect_list("partners").alias("partners")).mapInArrow(_count_links, "id long, linked long")
    edges = compared.select(F.col("id").alias("a"), F.col("root").alias("b"))
    about = reps.select("id", "key", "doc_id", "weight")
    if cliques is None:
        about = about.withColumn("fellows", F.lit(0))
    else:
        edges = edges.unionByName(cliques.select(F.col("id").alias("a"), F.col("clique").alias("b")))
        size = cliques.join(reps.select("id", "weight"), "id").groupBy("clique").agg(F.sum("weight").alias("fellows"))
        inside_of = cliques.join(size, "clique").select("id", "fellows")
        about = about.join(inside_of, "id", "left").withColumn("fellows", F.coalesce(F.col("fellows") - F.col("weight"), F.lit(0)))
    groups = union_find(edges)
    about = about.join(groups.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    smallest = about.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return sets.select("doc_id", "text_hash", "key"), (
        about.join(links, "id", "left").join(smallest, "root")
        .select("key", "class_id", (F.col("weight") - 1 + F.col("fellows") + F.coalesce("linked", F.lit(0))).alias("n_links"), "root")
    )


def near_duplicates(
    docs: DataFrame, *, k: int = SHINGLE, threshold: float = SIMILARITY, recall: float = RECALL, seed: int = 1
) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, class_id, n_links).

    Two documents are linked if their sets of k-word shingles have that Jaccard similarity at least.
    ``class_id`` is the smallest doc_id that links lead to; ``n_links`` counts the other documents
    linked to this one, copies included. Equal sets are always linked. A text of one to k - 1 words
    is one shingle; a text without words (null, empty) has no links and is a class of its own. Rows
    of one doc_id are separate documents. A null doc_id takes part; its class is the smallest id
    that is not null, null if there is none.
    """
    sets, about = _classes(docs, k, threshold, recall, seed)
    return sets.join(about, "key", "left").select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def keep_one(
    docs: DataFrame, *, k: int = SHINGLE, threshold: float = SIMILARITY, recall: float = RECALL, seed: int = 1
) -> DataFrame:
    """One row of each class of near duplicates, with all its columns: that of the smallest doc_id,
    null last; of rows with one id the one whose text's hash is smallest.

    Rows are judged one by one, also those that share an id or have none. Rows with the same id and
    the same text are one class; which of them stays follows from their other columns. Rows without
    words stay, all of them.
    """
    sets, about = _classes(docs, k, threshold, recall, seed)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    rows = sets.where("key is not null").join(about.select("key", "root"), "key").select("root", place.alias("place"))
    first = rows.groupBy("root").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = rows.join(first, "root")
    lost = small_enough(again.where("place <> first").select("place.doc_id", "place.text_hash").distinct().toDF("_id", "_hash"), 32)
    # Rows that no text tells apart from the one that stays.
    ties = again.where("place = first").groupBy("place").count().where("count > 1").select("place.doc_id", "place.text_hash").toDF("_id", "_hash")
    ties = small_enough(ties, 32)
    # Columns are told by position, so any name is fine.
    own = docs.toDF(*(str(i) for i in range(len(docs.columns))))
    doc_id, text = (F.col(str(docs.columns.index(c))) for c in ("doc_id", "text"))
    own = own.withColumns({"row_id": doc_id.cast("long"), "row_hash": F.xxhash64(text.cast("string"))})
    same = F.col("row_id").eqNullSafe(F.col("_id")) & F.col("row_hash").eqNullSafe(F.col("_hash"))
    kept = own.join(lost, same, "left_anti")
    order = Window.partitionBy("row_id", "row_hash").orderBy(F.xxhash64(*(c for c, kind in own.dtypes if "map<" not in kind)))
    first_tie = kept.join(ties, same, "left_semi").withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")
    out = kept.join(ties, same, "left_anti").unionByName(first_tie)
    return out.drop("row_id", "row_hash").toDF(*docs.columns)
