"""Substring dedup by level-wise doubling.

Windows of half the wanted length are looked up first. Only where the windows at i and i + half are
both repeated can the window of full length at i be repeated, so only those are extended and looked
up again, exactly. The first lookup therefore needs no more than 32 bits of hash within a bucket: a
false match costs a candidate, never a result.

Documents are dealt to homes by a hash of the row. A home sends each bucket its distinct window
hashes once, however often they occur in it, and gets one bit for each back, in the same order. So
neither positions nor texts travel with the hashes, and a passage that a third of all rows share
arrives once per home. Documents without candidates are finished after the first lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import documents, spread, written
from tickloom.llm.text import Words, grams, inside, runs, slices

WINDOW = 20
#: Bits of hash within a bucket in the first lookup.
BITS = 32
_LAST = np.iinfo(np.int64).max


def _ordered(table: pa.Table) -> pa.Table:
    """The rows in an order of their own, so that both visits to a home see them alike."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_end"))


def pieces(table: pa.Table):
    """Chunks of the ordered home: (record batch, words)."""
    for batch in slices(_ordered(table).combine_chunks().to_batches()):
        yield batch, Words.of(batch.column(batch.schema.get_field_index("text")))


def _short_codes(words: Words, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and hash bits of each window of ``length`` words, and which windows lie in one text."""
    hashes = grams(words.hashes(), length)
    bucket = (hashes >> np.uint64(BITS)) % np.uint64(buckets)
    return (bucket << np.uint64(BITS)) | (hashes & np.uint64((1 << BITS) - 1)), inside(words.first, len(hashes), length)


def _distinct_codes(table: pa.Table, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window codes of a home in order, and which of them it has more than once."""
    own = [code[ok] for _, words in pieces(table) for code, ok in [_short_codes(words, length, buckets)]]
    every = np.sort(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    at = np.flatnonzero(new)
    return every[at], np.diff(np.append(at, len(every))) > 1


def _send_short(length: int, buckets: int):
    def home(key: tuple, table: pa.Table) -> pa.Table:
        codes, often = _distinct_codes(table, length, buckets)
        border = np.searchsorted(codes, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(BITS))
        low = (codes & np.uint64((1 << BITS) - 1)).astype("<u4")
        some = np.flatnonzero(np.diff(border))
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "home": pa.array(np.full(len(some), key[0].as_py()), pa.int32()),
            "codes": pa.array([low[border[b] : border[b + 1]].tobytes() for b in some], pa.binary()),
            "often": pa.array([np.packbits(often[border[b] : border[b + 1]]).tobytes() for b in some], pa.binary()),
        })
    return home


def _match_short(table: pa.Table) -> pa.Table:
    """A bucket: one bit for each code sent, set if the code occurs twice in the corpus."""
    sent = [np.frombuffer(blob, "<u4") for blob in table["codes"].to_pylist()]
    every = np.sort(np.concatenate(sent))
    repeated = np.unique(every[1:][every[1:] == every[:-1]])
    flags = []
    for codes, bits in zip(sent, table["often"].to_pylist(), strict=True):
        often = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(codes)) > 0
        at = np.minimum(np.searchsorted(repeated, codes), max(len(repeated) - 1, 0))
        flags.append(np.packbits(often | (repeated[at] == codes) if len(repeated) else often).tobytes())
    return pa.table({"home": table["home"], "bucket": table["bucket"], "flags": pa.array(flags, pa.binary())})


def unpack(table: pa.Table, counts: np.ndarray) -> np.ndarray:
    """The flags of a home, bucket after bucket; ``counts`` has how many each bucket was sent."""
    order = pc.sort_indices(table, sort_keys=[("bucket", "ascending")])
    table = table.take(order)
    parts = [
        np.unpackbits(np.frombuffer(blob, np.uint8), count=counts[b])
        for b, blob in zip(table["bucket"].to_pylist(), table["flags"].to_pylist(), strict=True)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _finish(text: str | None, gone: np.ndarray | None) -> bytes:
    """The kept words, joined by one space."""
    words = (text or "").encode().split()
    return b" ".join(words if gone is None else [w for w, x in zip(words, gone, strict=True) if not x])


def _kept(digest: bool) -> Callable[[bytes], str]:
    return (lambda raw: hashlib.sha256(raw).hexdigest()) if digest else (lambda raw: raw.decode())


RESULT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>"


def _candidates(length: int, buckets: int, window: int, digest: bool):
    """Second visit to a home: finished documents, and those with candidates."""
    finish = _kept(digest)

    def home(key: tuple, docs: pa.Table, flags: pa.Table) -> pa.Table:
        codes, _ = _distinct_codes(docs, length, buckets)
        border = np.searchsorted(codes, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(BITS))
        repeated = codes[unpack(flags, np.diff(border))]
        out = []
        for batch, words in pieces(docs):
            code, ok = _short_codes(words, length, buckets)
            at = np.minimum(np.searchsorted(repeated, code), max(len(repeated) - 1, 0))
            flag = ok & (repeated[at] == code) if len(repeated) else np.zeros(len(code), bool)
            n = max(len(words.start) - window + 1, 0)
            both = inside(words.first, n, window)
            # Every window of this level inside the wider one; steps of its own length, and the last.
            for step in {*range(0, window - length + 1, length), window - length}:
                both = both & flag[step : step + n]
            cand = np.zeros(len(words.start), bool)
            cand[:n] = both
            number = np.add.reduceat(np.append(cand, False).astype(np.int64), words.first[:-1]) * (words.count > 0)
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            ids, first = batch.column(batch.schema.get_field_index("doc_id")), words.first
            out.append(pa.table({
                "doc_id": ids, "n_words": pa.array(words.count), "home": pa.array(np.full(len(ids), key[0].as_py()), pa.int32()),
                "kept": pa.array([None if k else finish(_finish(t, None)) for t, k in zip(texts, number, strict=True)], pa.string()),
                "text": pa.array([t if k else None for t, k in zip(texts, number, strict=True)], pa.string()),
                "cand": pa.array([np.packbits(cand[first[i] : first[i + 1]]).tobytes() if k else None for i, k in enumerate(number)], pa.binary()),
            }))
        return pa.concat_tables(out)
    return home


def _exact_windows(table: pa.Table, window: int) -> list[np.ndarray]:
    """Candidate windows of a home: two hashes, document order, document id, start, and the row."""
    out, row = [], 0
    for batch, words in pieces(table):
        cand = np.concatenate([
            np.unpackbits(np.frombuffer(blob, np.uint8), count=k)
            for blob, k in zip(batch.column(batch.schema.get_field_index("cand")).to_pylist(), words.count, strict=True)
        ]).astype(bool)
        at = np.flatnonzero(cand)
        doc = words.doc[at]
        ids = batch.column(batch.schema.get_field_index("doc_id")).fill_null(_LAST).to_numpy(zero_copy_only=False)
        out.append([grams(words.hashes(0), window)[at], grams(words.hashes(1), window, 1)[at], ids[doc], at - words.first[doc], row + doc])
        row += batch.num_rows
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _first_of(table: pa.Table, window: int, buckets: int):
    """The windows of a home sorted by bucket, hashes (96 bits) and place, and where a new hash begins."""
    h1, h2, doc, start, row = _exact_windows(table, window)
    h2 = h2 >> np.uint64(32)
    bucket = h1 % np.uint64(buckets)
    order = np.lexsort((start, doc, h2, h1, bucket))
    h1, h2, doc, start, row, bucket = (x[order] for x in (h1, h2, doc, start, row, bucket))
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return h1, h2, doc, start, row, bucket, np.flatnonzero(new)


def send_exact(window: int, buckets: int):
    def home(key: tuple, table: pa.Table) -> pa.Table:
        h1, h2, doc, start, _, bucket, at = _first_of(table, window, buckets)
        border = np.searchsorted(bucket[at], np.arange(buckets + 1, dtype=np.uint64))
        some = np.flatnonzero(np.diff(border))
        data = {"bucket": pa.array(some, pa.int32()), "home": pa.array(np.full(len(some), key[0].as_py()), pa.int32())}
        for name, values, kind in (("h1", h1, "<u8"), ("h2", h2, "<u4"), ("doc", doc, "<i8"), ("start", start, "<i4")):
            flat = values[at].astype(kind)
            data[name] = pa.array([flat[border[b] : border[b + 1]].tobytes() for b in some], pa.binary())
        return pa.table(data)
    return home


def match_exact(table: pa.Table) -> pa.Table:
    """A bucket: one bit for each window sent, set if it is the first of the corpus."""
    kinds = {"h1": "<u8", "h2": "<u4", "doc": "<i8", "start": "<i4"}
    h1, h2, doc, start = (np.concatenate([np.frombuffer(b, k) for b in table[c].to_pylist()]) for c, k in kinds.items())
    order = np.lexsort((start, doc, h2, h1))
    a, b, d, s = h1[order], h2[order], doc[order], start[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    first = np.empty(len(a), bool)
    first[order] = (d == d[head]) & (s == s[head])
    sizes = [len(x) // 4 for x in table["start"].to_pylist()]
    cut = np.cumsum([0, *sizes])
    flags = [np.packbits(first[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table({"home": table["home"], "bucket": table["bucket"], "flags": pa.array(flags, pa.binary())})


def late_windows(docs: pa.Table, flags: pa.Table, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of each candidate window that starts earlier elsewhere."""
    _, _, doc, start, row, bucket, at = _first_of(docs, window, buckets)
    counts = np.diff(np.searchsorted(bucket[at], np.arange(buckets + 1, dtype=np.uint64)))
    first = unpack(flags, counts)
    group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(doc))))
    later = ~first[group] | (doc != doc[at][group]) | (start != start[at][group]) if len(doc) else np.zeros(0, bool)
    return row[later], start[later]


def covered(docs: pa.Table, row: np.ndarray, start: np.ndarray, window: int):
    """For each chunk of a home: record batch, words, and for each text the flags of covered words."""
    order = np.argsort(row, kind="stable")
    row, start, base = row[order], start[order], 0
    for batch, words in pieces(docs):
        a, b = np.searchsorted(row, [base, base + batch.num_rows])
        place = words.first[row[a:b] - base] + start[a:b]
        n = len(words.start) + window + 1
        edge = np.bincount(place, minlength=n)[:n] - np.bincount(place + window, minlength=n)[:n]
        gone = np.cumsum(edge)[: len(words.start)] > 0
        yield batch, words, [gone[i:j] for i, j in zip(words.first[:-1], words.first[1:], strict=True)]
        base += batch.num_rows


def span_lists(each: list[np.ndarray]) -> pa.ListArray:
    """Runs of true flags as lists of (start, end)."""
    found = [runs(x) for x in each]
    flat = pa.StructArray.from_arrays(
        [pa.array(np.concatenate([s[k] for s in found]).astype(np.int64)) for k in (0, 1)], names=["start", "end"])
    at = np.cumsum([0, *(len(s[0]) for s in found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), flat)


def remove_covered(docs: pa.Table, flags: pa.Table, window: int, buckets: int, row: np.ndarray, start: np.ndarray) -> pa.Table:
    """Spans of the documents of a home: windows given by row and start, and the candidates that ``flags`` tell of."""
    more = late_windows(docs, flags, window, buckets)
    row, start = np.concatenate((row, more[0])), np.concatenate((start, more[1]))
    return pa.concat_tables([
        pa.table({
            "doc_id": batch.column(batch.schema.get_field_index("doc_id")), "n_words": pa.array(words.count),
            "n_repeated": pa.array([int(x.sum()) for x in each], pa.int64()), "spans": span_lists(each),
        })
        for batch, words, each in covered(docs, row, start, window)
    ])


def _remove(window: int, buckets: int, digest: bool):
    """Last visit: words covered by a window that starts earlier elsewhere."""
    finish = _kept(digest)

    def home(key: tuple, docs: pa.Table, flags: pa.Table) -> pa.Table:
        out = []
        for batch, words, each in covered(docs, *late_windows(docs, flags, window, buckets), window):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            out.append(pa.table({
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")), "n_words": pa.array(words.count),
                "n_removed": pa.array([int(x.sum()) for x in each], pa.int64()),
                "kept": pa.array([finish(_finish(t, x)) for t, x in zip(texts, each, strict=True)], pa.string()),
                "spans": span_lists(each),
            }))
        return pa.concat_tables(out)
    return home


def remove_repeats(docs: DataFrame, window: int = WINDOW, *, digest: bool = False) -> DataFrame:
    """Remove every word that a window covers whose words also start earlier in the corpus.

    Returns (doc_id, n_words, n_removed, kept, spans) for each row: ``kept`` is the kept words joined
    by one space, or with ``digest`` their SHA-256 in hex; ``spans`` are the removed runs of words,
    the end exclusive. Earlier is by doc_id, then by place in the text; rows of one doc_id are the
    same document, so equal rows keep or lose the same words; a null doc_id comes last. Windows are
    judged on the input. Null, empty and short texts lose nothing. Other columns are left behind.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    half = -(-window // 2)
    parts = spread(docs.sparkSession)
    buckets = 2 * parts
    homes = documents(docs).withColumn("home", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")).repartition(parts, "home")
    flags = (
        homes.groupBy("home").applyInArrow(_send_short(half, buckets), "bucket int, home int, codes binary, often binary")
        .groupBy("bucket").applyInArrow(_match_short, "home int, bucket int, flags binary")
    )
    seen = written(
        homes.groupBy("home").cogroup(flags.groupBy("home")).applyInArrow(
            _candidates(half, buckets, window, digest), "doc_id long, n_words long, home int, kept string, text string, cand binary"
        ), "candidates",
    )
    open_docs = seen.where("text is not null").select("doc_id", "text", "cand", "home").repartition(parts, "home")
    first = (
        open_docs.groupBy("home").applyInArrow(
            send_exact(window, buckets), "bucket int, home int, h1 binary, h2 binary, doc binary, start binary")
        .groupBy("bucket").applyInArrow(match_exact, "home int, bucket int, flags binary")
    )
    done = open_docs.groupBy("home").cogroup(first.groupBy("home")).applyInArrow(_remove(window, buckets, digest), RESULT)
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    return seen.where("text is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept", nothing.alias("spans")).unionByName(done)
