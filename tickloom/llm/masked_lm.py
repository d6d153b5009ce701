"""LM scoring by masked pseudo-likelihood.

A small bidirectional window network predicts every word from the two words on either side of it, as
if the word itself were masked. A word has one embedding, weighted by how far from the masked place it
stands. The vocabulary follows the corpus: every word that occurs often
enough has a code of its own, and only rarer ones share codes by their last two bytes. A code is a
path of digits (class, member, member of that, ...) to the base 32, so the softmax is over at most 32
branches at each level; a level more is added whenever the codes outgrow the levels. Each node has
its own gate on the hidden units and its own biases, so each word has weights of its own.

The vocabulary counts all words of all documents in Spark. Training sees every document once, half
of them in each of two rounds: on every core a task trains a copy of the weights in numpy on its rows.
What a task has moved is sent by blocks of weight rows and averaged over the tasks that saw a row, weighted
by how often they did; the driver gets each block's mean once. A document's score is the sum of its
words' conditional log-probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import documents, spread, written
from tickloom.llm.text import Words, slices

CLASSES = 32
#: Fewest codes of a model, and codes that words without one of their own share by their endings.
CODES, SHARED = CLASSES * CLASSES, 256
#: So many most frequent words have a code of their own at least, in a small corpus.
FREQUENT = CODES - SHARED
REACH, WIDTH = 2, 24
ROUNDS, BATCH, RATE, SEED = 2, 8192, 0.15, 5
#: Words that a task holds, at least, before it learns from them; only the last batch of them is smaller.
HELD = 16 * BATCH
#: Bias of a branch without codes.
CLOSED = -30.0
#: Rows of a weight table that are averaged as one.
BLOCK = 2048
_OFFSETS = [o for o in range(-REACH, REACH + 1) if o]


def least_count(words: int) -> int:
    """How often a word occurs at least to have a code, in a corpus of so many words."""
    return max(2, round(words**0.25))


def n_codes(frequent: np.ndarray) -> int:
    return max(CODES, len(frequent) + SHARED)


def _depth(codes: int) -> int:
    depth = 2
    while CLASSES**depth < codes:
        depth += 1
    return depth


def _level(level: int) -> str:
    return "" if level == 1 else str(level)


def shapes(codes: int) -> dict[str, tuple[int, ...]]:
    depth = _depth(codes)
    top = -(-codes // CLASSES ** (depth - 1))
    out = {"embed": (codes + 1, WIDTH), "reach": (len(_OFFSETS), WIDTH), "bias": (WIDTH,), "class": (WIDTH, top), "class_bias": (top,)}
    for level in range(1, depth):
        nodes, name = -(-codes // CLASSES ** (depth - level)), _level(level)
        out |= {f"given{name}": (nodes, WIDTH), f"gate{name}": (nodes, WIDTH), f"member{name}": (WIDTH, CLASSES),
                f"member_bias{name}": (nodes, CLASSES)}
    return out


def start_weights(codes: int = CODES) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)

    def start(name: str, shape: tuple[int, ...]) -> np.ndarray:
        if "bias" in name:
            return np.zeros(shape, np.float32)
        if name.startswith("gate") or name == "reach":
            return np.ones(shape, np.float32)
        return rng.standard_normal(shape, np.float32) * np.float32(0.1)

    out, depth = {k: start(k, s) for k, s in shapes(codes).items()}, _depth(codes)
    for level in range(depth):
        # At first a branch is as likely as the share of codes below it; one without codes is closed.
        bias = out[f"member_bias{_level(level)}" if level else "class_bias"].reshape(-1)
        each = CLASSES ** (depth - level - 1)
        below = np.clip(codes - np.arange(len(bias)) * each, 0, each) / each
        bias[:] = np.where(below > 0, np.log(np.maximum(below, 1e-9)), CLOSED)
    return out


def pack_weights(weights: dict[str, np.ndarray]) -> bytes:
    codes = len(weights["embed"]) - 1
    return b"".join([np.array([codes], "<i8").tobytes(), *(weights[k].astype("<f4", copy=False).tobytes() for k in shapes(codes))])


def unpack_weights(raw: bytes) -> dict[str, np.ndarray]:
    """The tables of packed weights; views that cannot be written to."""
    flat, out, at = np.frombuffer(raw, "<f4", offset=8), {}, 0
    for k, s in shapes(int(np.frombuffer(raw, "<i8", 1)[0])).items():
        n = math.prod(s)
        out[k] = flat[at : at + n].reshape(s)
        at += n
    return out


def encode(words: Words, frequent: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """Code of each word; ``frequent`` has the word hashes in the order of their codes, ``places``
    what ``slot_table`` makes of it."""
    codes = np.full(len(words.start), -1, np.int64)
    if len(frequent):
        codes[:] = find(words.hashes(), frequent, slot_table(frequent) if places is None else places)
    rare = np.flatnonzero(codes < 0)
    end = words.end[rare]
    last = words.data[end - 1].astype(np.int64)
    before = words.data[np.maximum(end - 2, 0)].astype(np.int64) * (end - words.start[rare] > 1)
    codes[rare] = n_codes(frequent) - SHARED + (last * 31 + before * 7) % SHARED
    return codes


def slot_table(frequent: np.ndarray) -> np.ndarray:
    """A table of codes by the low bits of the hashes, four times as large; -1 where it is free. A code
    whose slot is taken is in the next free one."""
    size = 1 << max(4, int(4 * len(frequent)).bit_length())
    table, codes = np.full(size, -1, np.int32), np.arange(len(frequent), dtype=np.int32)
    slots = (frequent & np.uint64(size - 1)).astype(np.int64)
    while len(codes):
        free = table[slots] < 0
        table[slots[free]] = codes[free]
        rest = table[slots] != codes
        codes, slots = codes[rest], (slots[rest] + 1) % size
    return table


def find(hashes: np.ndarray, frequent: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Code of each hash, -1 for one that has none."""
    slots = (hashes & np.uint64(len(table) - 1)).astype(np.int64)
    out = np.take(table, slots)
    wrong = np.flatnonzero((out >= 0) & (np.take(frequent, out) != hashes))
    while len(wrong):
        slots[wrong] = (slots[wrong] + 1) % len(table)
        out[wrong] = table[slots[wrong]]
        wrong = wrong[(out[wrong] >= 0) & (frequent[out[wrong]] != hashes[wrong])]
    return out


def missing(first: np.ndarray) -> list[np.ndarray]:
    """For each offset the words whose neighbour there is outside their text; ``first`` as in Words."""
    begin, end = np.unique(first[:-1]), np.unique(first[1:])
    out = []
    for offset in _OFFSETS:
        # The first words of a text have none before them, the last ones none behind them.
        edges, reach = (begin, range(-offset)) if offset < 0 else (end, range(-offset, 0))
        at = np.unique(np.concatenate([edges + k for k in reach]))
        out.append(at)
    n, text = int(first[-1]), np.repeat(np.arange(len(first) - 1), np.diff(first))
    return [at[_outside(at, offset, text, n)] for at, offset in zip(out, _OFFSETS, strict=True)]


def _outside(at: np.ndarray, offset: int, text: np.ndarray, n: int) -> np.ndarray:
    """Which of the words have no neighbour at that offset in their text."""
    own = (at >= 0) & (at < n)
    there = at + offset
    inside = own & (there >= 0) & (there < n)
    same = np.zeros(len(at), bool)
    same[inside] = text[at[inside]] == text[there[inside]]
    return own & ~same


@dataclass
class Sequence:
    """Words of some texts in a row, cut into batches."""

    codes: np.ndarray
    missing: list[np.ndarray]

    @classmethod
    def of(cls, codes: np.ndarray, first: np.ndarray) -> Sequence:
        return cls(codes, missing(first))

    def batches(self, size: int) -> Iterator[Batch]:
        for a in range(0, len(self.codes), size):
            yield self.batch(a, min(a + size, len(self.codes)))

    def batch(self, a: int, b: int) -> Batch:
        """The words from a to b, and those around them."""
        left, right = min(REACH, a), min(REACH, len(self.codes) - b)
        near = np.pad(self.codes[a - left : b + right], (REACH - left, REACH - right))
        gaps = [m[np.searchsorted(m, a) : np.searchsorted(m, b)] - a for m in self.missing]
        return Batch(self.codes[a:b], near, gaps)


@dataclass
class Batch:
    """Codes of a batch, the same with ``REACH`` words more on either side, and the words that have
    no neighbour at each offset."""

    codes: np.ndarray
    near: np.ndarray
    gaps: list[np.ndarray]

    def around(self, rows: np.ndarray, outside: np.ndarray, k: int) -> np.ndarray:
        """What stands at an offset from each word, of ``rows`` for the words of ``near``."""
        at = REACH + _OFFSETS[k]
        out = rows[at : at + len(self.codes)]
        if len(self.gaps[k]):
            out = out.copy()
            out[self.gaps[k]] = outside
        return out


def hidden_units(weights: dict[str, np.ndarray], batch: Batch) -> np.ndarray:
    """What the words around each word say about it; a row for each word."""
    rows, outside = np.take(weights["embed"], batch.near, axis=0), weights["embed"][-1]
    hidden = np.repeat(weights["bias"][None], len(batch.codes), axis=0)
    for k, offset in enumerate(_OFFSETS):
        reach, gaps = weights["reach"][k], batch.gaps[k]
        hidden += rows[REACH + offset : REACH + offset + len(batch.codes)] * reach
        if len(gaps):
            hidden[gaps] += (outside - rows[REACH + offset + gaps]) * reach
    return np.tanh(hidden, out=hidden)


@dataclass
class Level:
    """A level of the codes of a batch that is sorted by code: equal nodes stand together at each level."""

    nodes: np.ndarray
    first: np.ndarray
    times: np.ndarray
    branch: np.ndarray

    def spread(self, table: np.ndarray) -> np.ndarray:
        """The nodes' rows of a table, as a column for each word."""
        return np.repeat(np.take(table, self.nodes, axis=0).T, self.times, axis=1)


def _ascending(values: np.ndarray, below: int) -> np.ndarray:
    """Places of the values in ascending order; small numbers are sorted by their digits."""
    return np.argsort(values.astype(np.uint16), kind="stable") if below <= 1 << 16 else np.argsort(values)


def _levels(codes: np.ndarray, size: int) -> list[Level]:
    """From the top; ``codes`` ascend."""
    out = []
    for k in range(_depth(size) - 1, -1, -1):
        node = codes // CLASSES ** (k + 1)
        first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        out.append(Level(node[first], first, np.diff(np.append(first, len(codes))), codes // CLASSES**k % CLASSES))
    return out


def forward(weights: dict[str, np.ndarray], hidden: np.ndarray, levels: list[Level]):
    """For each level what its nodes make of the hidden units, and the weights of its branches before
    normalising; a column for each word, so that sums over branches run along words."""
    yield hidden, weights["class"].T @ hidden + weights["class_bias"][:, None]
    for number, level in enumerate(levels[1:], 1):
        name = _level(number)
        given = hidden * level.spread(weights[f"gate{name}"])
        given += level.spread(weights[f"given{name}"])
        logits = weights[f"member{name}"].T @ given
        logits += level.spread(weights[f"member_bias{name}"])
        yield given, logits


def log_probabilities(weights: dict[str, np.ndarray], hidden: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Conditional log-probability of each word, given the hidden units that the words around it make."""
    size = len(weights["embed"]) - 1
    order = _ascending(codes, size)
    out, total, row = np.empty(len(codes), np.float64), 0.0, np.arange(len(codes))
    levels = _levels(codes[order], size)
    for (_, logits), level in zip(forward(weights, np.ascontiguousarray(np.take(hidden, order, axis=0).T), levels), levels, strict=True):
        logits -= logits.max(0)
        total = total + logits[level.branch, row].astype(np.float64)
        total -= np.log(np.exp(logits, out=logits).sum(0))
    out[order] = total
    return out


def score_words(weights: dict[str, np.ndarray], codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Conditional log-probability of each word of some texts."""
    parts = [log_probabilities(weights, hidden_units(weights, b), b.codes) for b in Sequence.of(codes, first).batches(BATCH)]
    return np.concatenate(parts) if parts else np.zeros(0)


@dataclass
class Slope:
    """Slopes of some rows of a table, and how often each row was used."""

    shape: tuple[int, ...]
    at: np.ndarray
    rows: np.ndarray
    uses: np.ndarray

    @classmethod
    def of(cls, shape: tuple[int, ...], at: np.ndarray, each: np.ndarray) -> Slope:
        """Sums of the rows of ``each`` by the table rows ``at``."""
        order = _ascending(at, shape[0])
        ranked = at[order]
        fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        place = np.empty(len(at), np.int64)
        place[order] = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        rows = np.empty((len(first), each.shape[1]), np.float32)
        for i, own in enumerate(np.ascontiguousarray(each.T, np.float64)):
            rows[:, i] = np.bincount(place, own, len(first))
        return cls(shape, ranked[first], rows, np.diff(np.append(first, len(at))))

    @classmethod
    def whole(cls, table: np.ndarray, uses: int) -> Slope:
        rows = table.reshape(-1, table.shape[-1])
        return cls(table.shape, np.arange(len(rows)), rows, np.full(len(rows), uses))

    def __getitem__(self, index: tuple[int, ...]):
        table = np.zeros(self.shape, self.rows.dtype)
        table.reshape(-1, self.shape[-1])[self.at] = self.rows
        return table[index]


class Trainer:
    """Adagrad on mini-batches; rows of a table that a batch doesn't use are not touched."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.squares = {k: np.zeros(v.shape, np.float32) for k, v in weights.items()}
        self.uses = {k: np.zeros(v.size // v.shape[-1], np.int64) for k, v in weights.items()}

    def step(self, batch: Batch) -> None:
        w, n, codes = self.weights, len(batch.codes), batch.codes
        size = len(w["embed"]) - 1
        # One sort: the nodes of every level are then runs of words.
        order = _ascending(codes, size)
        levels, row, slopes = _levels(codes[order], size), np.arange(n), {}
        hidden = np.ascontiguousarray(np.take(hidden_units(w, batch), order, axis=0).T)
        for number, ((given, branches), level) in enumerate(zip(forward(w, hidden, levels), levels, strict=True)):
            branches -= branches.max(0)
            np.exp(branches, out=branches)
            branches /= branches.sum(0) * np.float32(n)
            branches[level.branch, row] -= np.float32(1 / n)
            if number == 0:
                d_hidden = w["class"] @ branches
                slopes |= {"class": Slope.whole(hidden @ branches.T, n), "class_bias": Slope.whole(branches.sum(1), n)}
                continue
            name = _level(number)
            d_given = w[f"member{name}"] @ branches
            for key, each in (("given", d_given), ("gate", d_given * hidden), ("member_bias", branches)):
                slopes[key + name] = Slope(w[key + name].shape, level.nodes, np.add.reduceat(each, level.first, axis=1).T, level.times)
            slopes[f"member{name}"] = Slope.whole(given @ branches.T, n)
            d_given *= level.spread(w[f"gate{name}"])
            d_hidden += d_given
        d_hidden *= 1 - hidden * hidden
        slopes["bias"] = Slope.whole(d_hidden.sum(1), n)
        back = np.empty((n, WIDTH), np.float32)
        back[order] = d_hidden.T
        slopes |= self._embedding(batch, back)
        self._move(slopes)

    def _embedding(self, batch: Batch, slope: np.ndarray) -> dict[str, Slope]:
        """Slopes of the embeddings and of the offsets' weights, from those of the words' sums."""
        w, n = self.weights, len(batch.codes)
        rows, outside = np.take(w["embed"], batch.near, axis=0), w["embed"][-1]
        each, edge, reach = np.zeros((len(batch.near) + 1, WIDTH), np.float32), 0, []
        for k, offset in enumerate(_OFFSETS):
            gaps = batch.gaps[k]
            seen = np.einsum("ij,ij->j", slope, rows[REACH + offset : REACH + offset + n])
            reach.append(seen + np.einsum("ij,ij->j", slope[gaps], outside - rows[REACH + offset + gaps]))
            own = slope * w["reach"][k]
            if len(gaps):
                each[-1] += own[gaps].sum(0)
                own[gaps] = 0
            each[REACH + offset : REACH + offset + n] += own
        at = np.append(batch.near, len(w["embed"]) - 1)
        return {"embed": Slope.of(w["embed"].shape, at, each), "reach": Slope.whole(np.array(reach), n)}

    def _move(self, slopes: dict[str, Slope]) -> None:
        for k, slope in slopes.items():
            width, rows = slope.shape[-1], slope.rows.astype(np.float32, copy=False)
            squares, table = self.squares[k].reshape(-1, width), self.weights[k].reshape(-1, width)
            total = np.take(squares, slope.at, axis=0)
            total += rows * rows
            squares[slope.at] = total
            np.sqrt(total + np.float32(1e-6), out=total)
            table[slope.at] = np.take(table, slope.at, axis=0) - np.float32(RATE) * rows / total
            self.uses[k][slope.at] += slope.uses


def _count(buckets: int):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            words, counts = np.unique(Words.of(batch.column(1)).hashes(), return_counts=True)
            bucket = words % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            border = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            words, counts = words[order].astype("<u8"), counts[order].astype("<i4")
            some = np.flatnonzero(np.diff(border))
            yield pa.record_batch([
                pa.array(some, pa.int32()),
                pa.array([words[border[b] : border[b + 1]].tobytes() for b in some], pa.binary()),
                pa.array([counts[border[b] : border[b + 1]].tobytes() for b in some], pa.binary()),
            ], ["bucket", "words", "counts"])
    return rows


def _total(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All words of a group with their counts, as one row."""
    words, counts = [], []
    for batch in batches:
        for w, n in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            words.append(np.frombuffer(w, "<u8"))
            counts.append(np.frombuffer(n, "<i4"))
    kinds, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts)).astype("<i8")
    yield pa.record_batch([pa.array([kinds.tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary()), pa.array([int(total.sum())])],
                          ["words", "counts", "n"])


def _above(least: int):
    """Of each group, the words that occur so often, and as many as a small vocabulary may need."""
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kinds, total = np.frombuffer(w, "<u8"), np.frombuffer(n, "<i8")
                top = np.lexsort((kinds, -total))[: max(FREQUENT, int((total >= least).sum()))]
                yield pa.record_batch([pa.array([kinds[top].tobytes()], pa.binary()), pa.array([total[top].tobytes()], pa.binary())], ["words", "counts"])
    return rows


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Hashes of the words with a code of their own, the most frequent first: all that occur
    ``least_count`` times in all documents, and the FREQUENT most frequent at least."""
    # A bucket's blobs are its share of the distinct words of all slices.
    buckets = 2 * spread(docs.sparkSession)
    counted = documents(docs).mapInArrow(_count(buckets), "bucket int, words binary, counts binary")
    totals = written(counted.groupBy("bucket").applyInArrow(_total, "words binary, counts binary, n long"), "words")
    least = least_count(totals.agg(F.sum("n")).first()[0] or 0)
    some = totals.select("words", "counts").mapInArrow(_above(least), "words binary, counts binary").collect()
    if not some:
        return np.zeros(0, np.uint64)
    kinds = np.frombuffer(b"".join(r["words"] for r in some), "<u8")
    total = np.frombuffer(b"".join(r["counts"] for r in some), "<i8")
    return kinds[np.lexsort((kinds, -total))[: max(FREQUENT, int((total >= least).sum()))]]


def _train(shared):
    def rows(batches: Iterable[pa.RecordBatch]):
        frequent, raw = shared.value
        start, places = unpack_weights(raw), slot_table(frequent)
        trainer = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def learn() -> None:
            codes = np.concatenate([c for c, _ in held])
            first = np.concatenate([[0], *(f[1:] + o for (_, f), o in zip(held, np.cumsum([0, *(len(c) for c, _ in held)])[:-1], strict=True))])
            for batch in Sequence.of(codes, first).batches(BATCH):
                trainer.step(batch)
            held.clear()

        for batch in slices(batches):
            trainer = trainer or Trainer({k: v.copy() for k, v in start.items()})
            words = Words.of(batch.column(1))
            codes = encode(words, frequent, places)
            held.append((codes, words.first))
            size += len(codes)
            if size >= HELD:
                learn()
                size = 0
        if size:
            learn()
        if trainer is None:
            return
        for place, (k, before) in enumerate(start.items()):
            used = np.flatnonzero(trainer.uses[k])
            if not len(used):
                continue
            width = before.shape[-1]
            cuts = np.flatnonzero(np.diff(used // BLOCK, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(used)], strict=True):
                at = used[a:b]
                # The moves of a task, not its weights: half precision is enough for them.
                moved = trainer.weights[k].reshape(-1, width)[at] - before.reshape(-1, width)[at]
                yield pa.record_batch(
                    [pa.array([place], pa.int32()), pa.array([int(at[0]) // BLOCK], pa.int32()),
                     pa.array([(at % BLOCK).astype("<i4").tobytes()], pa.binary()),
                     pa.array([trainer.uses[k][at].astype("<i8").tobytes()], pa.binary()), pa.array([moved.astype("<f2").tobytes()], pa.binary())],
                    ["place", "block", "at", "uses", "moved"],
                )
    return rows


def _average(widths: list[int]):
    def block(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The mean move of each row of a block, over the tasks that used the row."""
        place, number = (k.as_py() for k in key)
        total, seen = np.zeros((BLOCK, widths[place])), np.zeros(BLOCK, np.int64)
        for batch in batches:
            for at, uses, moved in zip(*(batch.column(c) for c in ("at", "uses", "moved")), strict=True):
                at, uses = np.frombuffer(at.as_py(), "<i4"), np.frombuffer(uses.as_py(), "<i8")
                total[at] += uses[:, None] * np.frombuffer(moved.as_py(), "<f2").reshape(len(at), -1).astype(np.float64)
                seen[at] += uses
        at = np.flatnonzero(seen)
        yield pa.record_batch(
            [pa.array([place], pa.int32()), pa.array([number], pa.int32()), pa.array([at.astype("<i4").tobytes()], pa.binary()),
             pa.array([(total[at] / seen[at, None]).astype("<f4").tobytes()], pa.binary())],
            ["place", "block", "at", "moved"],
        )
    return block


def train(docs: DataFrame) -> tuple[np.ndarray, bytes]:
    """Vocabulary and weights from all documents; the start weights if there is no word at all."""
    spark = docs.sparkSession
    frequent = vocabulary(docs)
    weights = start_weights(n_codes(frequent))
    names, widths = list(weights), [v.shape[-1] for v in weights.values()]
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((frequent, pack_weights(weights)))
        # One copy for each core: the moves that are sent are as many as the copies.
        part = documents(docs).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == turn).coalesce(spark.sparkContext.defaultParallelism)
        own = part.mapInArrow(
            _train(shared), "place int, block int, at binary, uses binary, moved binary")
        mean = own.groupBy("place", "block").applyInArrow(_average(widths), "place int, block int, at binary, moved binary")
        for r in written(mean, "moves").toLocalIterator():
            table = weights[names[r["place"]]].reshape(-1, widths[r["place"]])
            at = np.frombuffer(r["at"], "<i4") + r["block"] * BLOCK
            table[at] += np.frombuffer(r["moved"], "<f4").reshape(len(at), -1)
        shared.unpersist()
    return frequent, pack_weights(weights)


SCORES = "doc_id long, n_tokens long, pll double, mean_pll double"


def score(docs: DataFrame, model: tuple[np.ndarray, bytes] | None = None) -> DataFrame:
    """(doc_id, n_tokens, pll, mean_pll) of every row, over its whole text.

    ``pll`` is the sum of the words' conditional log-probabilities, ``mean_pll`` that per word. A text
    without words (null, empty) has pll 0 and a null mean. Repeated rows get the same score; a null
    doc_id stays; other columns are left behind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def rows(batches: Iterable[pa.RecordBatch]):
        frequent, raw = shared.value
        weights, places = unpack_weights(raw), slot_table(frequent)
        for batch in slices(batches):
            words = Words.of(batch.column(1))
            codes = encode(words, frequent, places)
            each = score_words(weights, codes, words.first)
            total = np.diff(np.concatenate(([0.0], np.cumsum(each)))[words.first])
            count = words.count
            mean = np.divide(total, count, out=np.zeros(len(count)), where=count > 0)
            yield pa.record_batch(
                [batch.column(0), pa.array(count), pa.array(np.where(count > 0, total, 0.0)), pa.array(mean, mask=count == 0)],
                ["doc_id", "n_tokens", "pll", "mean_pll"],
            )

    return documents(docs).mapInArrow(rows, SCORES)
