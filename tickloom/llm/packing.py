"""Sequence packing by cutting-stock column generation.

Documents become token ids and one end id. A document longer than a sequence gives whole sequences;
what is left of it, 1 to 1023 ids, is a piece to be packed. The histogram of piece lengths, in steps
of ``STEP`` ids, is a cutting-stock problem: choose how often to use each pattern (a multiset of
lengths that fits a sequence) so that all pieces are used and the least is padded. Its linear
program is solved by column generation: the master keeps one column for each length; an unbounded
knapsack by dynamic programming prices new patterns. A pattern whose sum is a power of two needs no
padding, so it costs its sum; any other costs a full sequence.

The plan is one, from the histogram of all documents. Every task then applies the rounded amounts of
its share to its own pieces, ranked within each length, so no token moves between tasks. Pieces that
rounding leaves over go through a queue. It fills what the steps leave open in the patterns'
sequences; the rest of it is cut at each 1024 ids, its last ids into powers of two. Nothing is
padded, and only the documents of the queue are cut.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import documents, written
from tickloom.llm.text import slices

CAPACITY = 1024
#: Ids of a step of the histogram; the plan is good enough this close to the bound of no padding.
STEP, GAP = 8, 0.001
#: Ids that a task packs at once, and distinct strings that a worker remembers.
BLOCK, REMEMBER = 8_000_000, 600_000

#: Fixed value: the public pattern that byte-level BPE splits text by before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def cost(total: int, capacity: int) -> int:
    """What a sequence of ``total`` takes up; a power of two is not padded."""
    return total if total & (total - 1) == 0 else capacity


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each exact total, lengths 1.. taken any number of times, and the last length taken."""
    best = np.full(capacity + 1, -np.inf)
    last = np.zeros(capacity + 1, np.int64)
    best[0] = 0
    for total in range(1, capacity + 1):
        sums = value[1 : total + 1] + best[total - 1 :: -1] if total < len(value) else value[1:] + best[total - 1 : total - len(value) : -1]
        i = int(sums.argmax())
        best[total], last[total] = sums[i], i + 1
    return best, last


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> list[tuple[dict[int, int], float]]:
    """Patterns {length: copies} with their amounts, by column generation; amounts use every piece."""
    lengths = np.array(sorted(histogram), np.int64)
    m = len(lengths)
    if m == 0:
        return []
    # Slightly different amounts, so that pivots do not stall on ties.
    pieces = np.array([histogram[n] for n in lengths], np.float64) * (1 + 1e-4 * np.random.default_rng(3).random(m))
    copies = capacity // lengths
    # Fewer copies, if their sum is a power of two and so costs less for each.
    price = np.array([cost(int(n * c), capacity) / c for n, c in zip(lengths, copies, strict=True)])
    for i, n in enumerate(lengths):
        for c in range(1, int(copies[i])):
            if cost(int(n * c), capacity) / c < price[i]:
                copies[i], price[i] = c, cost(int(n * c), capacity) / c
    patterns = [{i: int(c)} for i, c in enumerate(copies)]
    costs = price * copies
    inverse = np.diag(1.0 / copies)
    amount = pieces / copies
    least = float(lengths @ pieces)
    totals = np.arange(capacity + 1)
    charge = np.array([cost(int(t), capacity) if t else np.inf for t in totals], np.float64)
    value = np.full(int(lengths[-1]) + 1, -np.inf)
    for _ in range(20 * m):
        if costs @ amount <= (1 + gap) * least:
            break
        dual = costs @ inverse
        value[lengths] = dual
        best, last = knapsack(value, capacity)
        worth = best - charge
        total = int(worth.argmax())
        if worth[total] <= 1e-7 * capacity:
            break
        column, pattern, charged = np.zeros(m), {}, charge[total]
        while total:
            i = int(np.searchsorted(lengths, last[total]))
            pattern[i] = pattern.get(i, 0) + 1
            column[i] += 1
            total -= int(last[total])
        step = inverse @ column
        up = step > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = amount[up] / step[up]
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        patterns[out], costs[out] = pattern, charged
    return [({int(lengths[i]): c for i, c in p.items()}, float(x)) for p, x in zip(patterns, amount, strict=True) if x > 1e-9]


class _Known(dict):
    """Ids of strings met so far, each encoded once; None for one that a space may not follow."""

    def __init__(self, encode, kind: str, lead: str):
        super().__init__()
        self.encode, self.kind, self.lead = encode, kind, lead

    def __missing__(self, string: str) -> bytes | None:
        ids = None
        if string and not string[-1].isspace():
            ids = array(self.kind, self.encode(self.lead + string)).tobytes()
        self[string] = ids
        return ids


class Encoder:
    """Token ids of whole texts.

    A space after a non-space always starts a new token of the byte-level pattern. So the strings
    between spaces are encoded once each and remembered, and joining their ids gives the ids of the
    text; a text with other white space before a space is encoded whole. A byte-level BPE whose
    merges are in the order of their ids is run through its ranks, which gives the same ids faster
    for short strings; any other vocabulary, and a text that has the string of an added token in it, by
    its own tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        self.encode_whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.encode_one = _ranked(about) or self.encode_whole
        #: Strings that the tokenizer takes for tokens of their own, wherever they stand.
        self.added = [t["content"] for t in about.get("added_tokens", ()) if t["content"]]
        self.kind = np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.kind == np.uint16 else "I"
        byte_level = (about.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not about.get("normalizer")
        self.first, self.rest = (_Known(self.encode_one, self.code, lead) for lead in ("", " "))
        self.split = byte_level

    def encode(self, text: str) -> bytes:
        if any(string in text for string in self.added):
            return array(self.code, self.encode_whole(text)).tobytes()
        if self.split:
            if len(self.rest) + len(self.first) > REMEMBER:
                self.rest.clear()
                self.first.clear()
            head, *tail = text.split(" ")
            try:
                return self.first[head] + b"".join(map(self.rest.__getitem__, tail))
            except TypeError:
                pass
        return array(self.code, self.encode_one(text)).tobytes()


def _ranked(about: dict):
    """The encoder by ranks, if the vocabulary is a byte-level BPE with merges in the order of ids."""
    pre, model = about.get("pre_tokenizer") or {}, about["model"]
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or about.get("normalizer") or model.get("type") != "BPE":
        return None
    import tiktoken

    # Byte-level vocabularies write bytes without a visible character from U+0100 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"] for t in about.get("added_tokens", ())}
    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][m] for m in merged]
    if order != sorted(order) or len(ranks) != 256 + len(merged):
        return None
    encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary


def _encode(path: str, end: int):
    def rows(batches: Iterable[pa.RecordBatch]):
        encoder = Encoder(path)
        tail = np.array([end], encoder.kind).tobytes()
        width = len(tail)
        for batch in slices(batches):
            ids = [encoder.encode(t or "") + tail for t in batch.column(1).to_pylist()]
            n = np.array([len(x) // width for x in ids], np.int64)
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "n", "ids"])
    return rows


def token_ids(docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """(doc_id, n, ids): ids of every whole text and the end id, little-endian, 2 bytes each (4 for
    vocabularies over 65,536). A null text is empty and gives the end id alone."""
    return documents(docs).mapInArrow(_encode(path, end), "doc_id long, n long, ids binary")


def assign(n: np.ndarray, plan: list[tuple[dict[int, int], float]], share: float, capacity: int, step: int = STEP):
    """Pack documents of ``n`` ids: (document, start, length, sequence, offset) and the number of sequences.

    ``plan`` is in steps; ``share`` is the part of the plan's pieces that these documents are.
    """
    whole, left = n // capacity, n % capacity
    doc = np.repeat(np.arange(len(n)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    out = [(doc, nth * capacity, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    # Documents ranked within their length class.
    steps = -(-left // step)
    ranked = np.lexsort((left, steps))
    where = np.searchsorted(steps[ranked], np.arange(capacity // step + 2))
    taken, have = where[:-1].copy(), where[1:]
    used: list[tuple[np.ndarray, np.ndarray]] = []
    room: list[np.ndarray] = []

    def use(pattern: dict[int, int], times: int) -> None:
        base = sum(map(len, room))
        for size, copies in sorted(pattern.items(), reverse=True):
            own = ranked[taken[size] : taken[size] + times * copies]
            taken[size] += times * copies
            used.append((own, base + np.arange(len(own)) // copies))
        room.append(np.full(times, cost(sum(k * v for k, v in pattern.items()) * step, capacity)))

    def possible(pattern: dict[int, int]) -> int:
        return min(int(have[k] - taken[k]) // c for k, c in pattern.items())

    for pattern, amount in plan:
        if times := min(possible(pattern), int(amount * share)):
            use(pattern, times)
    for pattern, amount in sorted(plan, key=lambda x: -(x[1] * share % 1)):
        if times := min(possible(pattern), int(amount * share % 1 + 0.5)):
            use(pattern, times)
    own, seq = (np.concatenate(x) for x in zip(*used, strict=True)) if used else (np.zeros(0, np.int64),) * 2
    rooms = np.concatenate(room) if room else np.zeros(0, np.int64)
    rest = np.concatenate([ranked[taken[k] : have[k]] for k in range(capacity // step, 0, -1)])
    # As many sequences as the queue can fill up; the pieces of the others join it.
    filled = np.bincount(seq, left[own], len(rooms)).astype(np.int64)
    spare = left[rest].sum() + np.concatenate((np.cumsum(filled[::-1])[::-1], [0]))
    keep = int(np.flatnonzero(spare >= np.concatenate(([0], np.cumsum(rooms - filled))))[-1])
    rest = np.concatenate((own[seq >= keep], rest))
    own, seq, filled, rooms = own[seq < keep], seq[seq < keep], filled[:keep], rooms[:keep]
    order = np.argsort(seq, kind="stable")
    own, seq = own[order], seq[order]
    size = left[own]
    out.append((own, n[own] - size, size, len(doc) + seq, np.cumsum(size) - size - (np.cumsum(filled) - filled)[seq]))
    size = left[rest]
    stop = np.cumsum(size)
    total = int(size.sum()) - int((rooms - filled).sum())
    tail = [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if (total % capacity) >> b & 1]
    sizes = np.concatenate((rooms - filled, np.full(total // capacity, capacity), np.array(tail, np.int64)))
    begins = np.concatenate((filled, np.zeros(total // capacity + len(tail), np.int64)))
    border = np.concatenate(([0], np.cumsum(sizes)))
    cuts = np.union1d(border, np.concatenate(([0], stop)))
    begin, length = cuts[:-1], np.diff(cuts)
    piece = np.searchsorted(stop, begin, "right")
    seq = np.searchsorted(border, begin, "right") - 1
    own = rest[piece]
    out.append((own, n[own] - left[own] + begin - (stop - size)[piece], length, len(doc) + seq, begins[seq] + begin - border[seq]))
    return (*(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)), len(doc) + len(sizes))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(plan: list[tuple[dict[int, int], float]], pieces: int, capacity: int, wide: bool):
    kind = np.uint32 if wide else np.uint16

    def block(ids: list[int | None], n: np.ndarray, blobs: list[bytes], base: int):
        share = np.count_nonzero(n % capacity) / max(1, pieces)
        doc, start, length, sequence, offset, used = assign(n, plan, share, capacity)
        flat = np.frombuffer(b"".join(blobs), kind).astype("<u4").tobytes()
        first = (np.cumsum(n) - n)[doc] + start
        crc = [zlib.crc32(flat[4 * a : 4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist(), strict=True)]
        return used, pa.record_batch(
            [pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
             pa.array(n[doc]), pa.array(base + sequence), pa.array(offset)],
            [x.split()[0] for x in PIECES.split(", ")],
        )

    def rows(batches: Iterable[pa.RecordBatch]):
        # Sequences of a task are numbered from its own range.
        base, ids, sizes, blobs, held = TaskContext.get().partitionId() << 40, [], [], [], 0
        for batch in batches:
            for i, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                sizes.append(n)
                blobs.append(blob)
                held += n
                if held >= BLOCK:
                    used, out = block(ids, np.array(sizes, np.int64), blobs, base)
                    yield out
                    base, ids, sizes, blobs, held = base + used, [], [], [], 0
        if ids:
            yield block(ids, np.array(sizes, np.int64), blobs, base)[1]
    return rows


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``capacity`` is a power of two. Every id of every document, the end id included, is in exactly
    one piece; a sequence's pieces follow each other from offset 0. Null and empty texts are
    documents of one id; rows that repeat a doc_id, or have none, are packed apart and keep their
    id; other columns are left behind. ``ids_crc32`` is over the piece's ids as unsigned
    little-endian 32-bit numbers.
    """
    if capacity & (capacity - 1) or capacity < 2 * STEP:
        raise ValueError(f"capacity must be a power of two, {2 * STEP} at least")
    tokens = written(token_ids(docs, tokenizer, end), "tokens")
    left = F.ceil(F.col("n") % capacity / STEP)
    histogram = {r["left"]: r["pieces"] for r in tokens.where(F.col("n") % capacity > 0).groupBy(left.alias("left")).agg(F.count("*").alias("pieces")).collect()}
    plan = plan_patterns(histogram, capacity // STEP)
    width = tokens.select((F.length("ids") / F.col("n")).alias("w")).limit(1).collect()
    wide = bool(width) and width[0]["w"] == 4
    return tokens.mapInArrow(_pack(plan, sum(histogram.values()), capacity, wide), PIECES)
