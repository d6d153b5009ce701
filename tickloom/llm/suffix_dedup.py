"""Suffix-array dedup with sparse suffix arrays.

Only suffixes at content-selected positions are kept: the minimiser of each ``RANGE`` word grams in a
row, so that every passage of ``min_words`` words has at least one, at the same place in each copy.

1. Each home (documents dealt by a hash of the row) sends the distinct gram hashes of its kept
   suffixes, with their numbers, to buckets, and hears which occur once in the corpus; those are
   given up. Most suffixes end here, with 8 bytes sent for each.
2. The other suffixes go to their gram's bucket with the words around them. There they are sorted and
   compared with their neighbours; the common prefix extends the match to the right. Among suffixes
   that share r words to the right, sorting by the words to the left and comparing neighbours again
   extends it to the left. For each r the suffixes that agree on min_words - r words to the left form
   a class, whose first member is the source of the others. That finds every repeated window of
   min_words words that has a kept suffix, and so every one.
3. A gram with more than ``HOT`` suffixes would fill one task. Its windows are looked up one by one by
   their own hash instead, distinct ones once per home, which gives the same answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import documents, spread, written
from tickloom.llm.substring_dedup import match_exact, pieces, remove_covered, send_exact
from tickloom.llm.text import Words, grams, inside

MIN_WORDS, GRAM = 50, 10
#: Suffixes of one gram that are sorted in one bucket.
HOT = 20_000
_LAST = np.iinfo(np.int64).max


def minimisers(words: Words, hashes: np.ndarray, gram: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the smallest gram hash of each ``reach`` grams in a row inside a text, with their hashes."""
    own = grams(hashes, gram)
    n = len(own) - reach + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, size = own, 1
    while size < reach:
        step = min(size, reach - size)
        least = np.minimum(least[: len(least) - step], least[step:])
        size += step
    ok = inside(words.first, n, gram + reach - 1)
    chosen = np.zeros(len(own), bool)
    # The leftmost or rightmost of equal hashes makes no difference: equal grams are equal words.
    for shift in range(reach):
        at = np.flatnonzero(ok & (own[shift : shift + n] == least)) + shift
        chosen[at] = True
    at = np.flatnonzero(chosen)
    return at, own[at]


def _home_suffixes(table: pa.Table, gram: int, reach: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(minimisers(w, w.hashes(), gram, reach)[1] for _, w in pieces(table))])


def _split(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, then value, and the borders of the buckets in it."""
    bucket = values % np.uint64(buckets)
    order = np.lexsort((values, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _send_grams(gram: int, reach: int, buckets: int):
    def home(key: tuple, table: pa.Table) -> pa.Table:
        codes, counts = np.unique(_home_suffixes(table, gram, reach), return_counts=True)
        order, border = _split(codes, buckets)
        codes, counts = codes[order].astype("<u8"), counts[order].astype("<u4")
        some = np.flatnonzero(np.diff(border))
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "home": pa.array(np.full(len(some), key[0].as_py()), pa.int32()),
            "codes": pa.array([codes[border[b] : border[b + 1]].tobytes() for b in some], pa.binary()),
            "counts": pa.array([counts[border[b] : border[b + 1]].tobytes() for b in some], pa.binary()),
        })
    return home


def _match_grams(hot: int):
    def bucket(table: pa.Table) -> pa.Table:
        """For each gram sent: 0 it occurs once, 1 more often, 2 more than ``hot`` times."""
        sent = [np.frombuffer(b, "<u8") for b in table["codes"].to_pylist()]
        counts = np.concatenate([np.frombuffer(b, "<u4") for b in table["counts"].to_pylist()])
        _, place = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(place, counts)[place]
        kind = ((total > 1).astype(np.uint8) + (total > hot)).astype(np.uint8)
        cut = np.cumsum([0, *map(len, sent)])
        flags = [kind[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"home": table["home"], "bucket": table["bucket"], "flags": pa.array(flags, pa.binary())})
    return bucket


def _keep_repeated(gram: int, reach: int, buckets: int, span: int):
    """Second visit: documents with no repeated suffix are done; others carry a mark for each word
    (1: repeated suffix, 2: hot one) and the candidate windows of hot ones."""

    def home(key: tuple, docs: pa.Table, flags: pa.Table) -> pa.Table:
        codes = np.unique(_home_suffixes(docs, gram, reach))
        codes = codes[_split(codes, buckets)[0]]
        table = flags.take(pc.sort_indices(flags, sort_keys=[("bucket", "ascending")]))
        kind = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(b, np.uint8) for b in table["flags"].to_pylist())])
        by_code = np.argsort(codes)
        codes, kind = codes[by_code], kind[by_code]
        out = []
        for batch, words in pieces(docs):
            at, own = minimisers(words, words.hashes(), gram, reach)
            mark, cand = np.zeros(len(words.start), np.uint8), np.zeros(len(words.start) + 1, np.int64)
            if len(own):
                mark[at] = kind[np.searchsorted(codes, own)]
            hot = np.flatnonzero(mark == 2)
            first, last = words.first[words.doc[hot]], words.first[words.doc[hot] + 1]
            low, high = np.maximum(hot + gram - span, first), np.minimum(hot, last - span)
            np.add.at(cand, low[low <= high], 1)
            np.add.at(cand, high[low <= high] + 1, -1)
            wide = np.cumsum(cand[:-1]) > 0
            some = np.add.reduceat(np.append(mark > 0, False).astype(np.int64), words.first[:-1]) * (words.count > 0)
            cuts, texts = words.first, batch.column(batch.schema.get_field_index("text")).to_pylist()
            out.append(pa.table({
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")), "n_words": pa.array(words.count),
                "home": pa.array(np.full(batch.num_rows, key[0].as_py()), pa.int32()),
                "text": pa.array([t if k else None for t, k in zip(texts, some, strict=True)], pa.string()),
                "mark": pa.array([mark[cuts[i] : cuts[i + 1]].tobytes() if k else None for i, k in enumerate(some)], pa.binary()),
                "cand": pa.array([np.packbits(wide[cuts[i] : cuts[i + 1]]).tobytes() if k else None for i, k in enumerate(some)], pa.binary()),
            }))
        return pa.concat_tables(out)
    return home


def _contexts(table: pa.Table, gram: int, span: int):
    """Repeated suffixes of a home: gram hash, words to the right, words to the left (nearest first),
    document, start, row and, for those of equal surroundings, the first one's number."""
    left, right = span - gram, span
    out, row = [], 0
    for batch, words in pieces(table):
        mark = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("mark")).to_pylist()), np.uint8)
        at = np.flatnonzero(mark == 1)
        hashes = words.hashes()
        short = np.concatenate((np.zeros(left, np.uint32), (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.zeros(right, np.uint32)))
        doc = words.doc[at]
        first, last = words.first[doc], words.first[doc + 1]
        ahead = short[at[:, None] + left + np.arange(right)] * (at[:, None] + np.arange(right) < last[:, None])
        back = short[at[:, None] + left - 1 - np.arange(left)] * (at[:, None] - 1 - np.arange(left) >= first[:, None])
        ids = batch.column(batch.schema.get_field_index("doc_id")).fill_null(_LAST).to_numpy(zero_copy_only=False)
        code = grams(hashes, gram)[at] if len(at) else np.zeros(0, np.uint64)
        out.append([code, ahead.astype(">u4"), back.astype(">u4"), ids[doc], at - first, row + doc])
        row += batch.num_rows
    code, ahead, back, doc, start, row = (np.concatenate(x) for x in zip(*out, strict=True))
    near = np.ascontiguousarray(np.hstack([ahead, back])).view(f"S{4 * (left + right)}").ravel()
    order = np.lexsort((start, doc, near, code))
    new = np.ones(len(code), bool)
    new[1:] = (code[order][1:] != code[order][:-1]) | (near[order][1:] != near[order][:-1])
    return [x[order] for x in (code, ahead, back, doc, start, row)], new


def _send_contexts(gram: int, span: int, buckets: int):
    def home(key: tuple, table: pa.Table) -> pa.Table:
        (code, ahead, back, doc, start, _), new = _contexts(table, gram, span)
        at = np.flatnonzero(new)
        bucket = code[at] % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        at, border = at[order], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        some = np.flatnonzero(np.diff(border))
        data = {"bucket": pa.array(some, pa.int32()), "home": pa.array(np.full(len(some), key[0].as_py()), pa.int32())}
        for name, values, kind in (("code", code, "<u8"), ("ahead", ahead, ">u4"), ("back", back, ">u4"), ("doc", doc, "<i8"), ("start", start, "<i4")):
            data[name] = pa.array([values[at[border[b] : border[b + 1]]].astype(kind).tobytes() for b in some], pa.binary())
        return pa.table(data)
    return home


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal words at the beginning of each pair of rows; 0 marks the outside of a text."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def repeated_windows(code, ahead, back, doc, start, gram: int, span: int) -> np.ndarray:
    """For each suffix, 64-bit flags: bit r - gram says that the window of ``span`` words with r words
    from the suffix on also starts earlier. All rows of a gram must be there."""
    n = len(code)
    flags = np.zeros(n, np.uint64)
    if n < 2:
        return flags
    # The suffix array of this bucket, and its neighbours' common prefixes.
    text = np.ascontiguousarray(ahead).view(f"S{4 * ahead.shape[1]}").ravel()
    array = np.lexsort((text, code))
    prefix = np.where(code[array][1:] == code[array][:-1], _common(ahead[array][1:], ahead[array][:-1]), 0)
    # Suffixes by the words before them.
    before = np.ascontiguousarray(back).view(f"S{4 * back.shape[1]}").ravel()
    rank = np.empty(n, np.int64)
    rank[np.argsort(before, kind="stable")] = np.arange(n)
    for r in range(gram, span + 1):
        group = np.concatenate(([0], np.cumsum(prefix < r)))
        size = np.bincount(group)
        many = size[group] > 1
        own, group = array[many], group[many]
        if not len(own):
            break
        order = np.lexsort((rank[own], group))
        own, group = own[order], group[order]
        need = span - r
        same = (group[1:] == group[:-1]) & (_common(back[own][1:, :need], back[own][:-1, :need]) == need if need else True)
        kind = np.concatenate(([0], np.cumsum(~same)))
        place = np.lexsort((start[own], doc[own], kind))
        head = np.maximum.accumulate(np.where(np.concatenate(([True], kind[place][1:] != kind[place][:-1])), np.arange(len(own)), 0))
        ranked = own[place]
        source = ranked[head]
        later = (doc[ranked] != doc[source]) | (start[ranked] != start[source])
        flags[ranked[later]] |= np.uint64(1 << (r - gram))
        # Of copies in one class at one home, only the first was sent; see _close.
    return flags


def _match_contexts(gram: int, span: int):
    def bucket(table: pa.Table) -> pa.Table:
        sent = {c: table[c].to_pylist() for c in ("code", "ahead", "back", "doc", "start")}
        code, doc, start = (np.frombuffer(b"".join(sent[c]), k) for c, k in (("code", "<u8"), ("doc", "<i8"), ("start", "<i4")))
        ahead = np.frombuffer(b"".join(sent["ahead"]), ">u4").reshape(-1, span)
        back = np.frombuffer(b"".join(sent["back"]), ">u4").reshape(-1, span - gram)
        flags = repeated_windows(code, ahead, back, doc, start, gram, span).astype("<u8")
        cut = np.cumsum([0, *(len(b) // 8 for b in sent["code"])])
        out = [flags[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({"home": table["home"], "bucket": table["bucket"], "flags": pa.array(out, pa.binary()),
                         "kind": pa.array(np.zeros(len(out)), pa.int32())})
    return bucket


def _match_hot(table: pa.Table) -> pa.Table:
    out = match_exact(table)
    return out.append_column("kind", pa.array(np.ones(out.num_rows), pa.int32()))


def _close(gram: int, span: int, buckets: int):
    """Last visit: all windows that start earlier elsewhere, from both lookups, as spans."""

    def home(key: tuple, docs: pa.Table, flags: pa.Table) -> pa.Table:
        (code, ahead, back, doc, start, row), new = _contexts(docs, gram, span)
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        order = np.argsort(code[at] % np.uint64(buckets), kind="stable")
        sorted_rows = flags.filter(pc.equal(flags["kind"], 0))
        sorted_rows = sorted_rows.take(pc.sort_indices(sorted_rows, sort_keys=[("bucket", "ascending")]))
        heard = np.zeros(len(at), np.uint64)
        heard[order] = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(b, "<u8") for b in sorted_rows["flags"].to_pylist())])
        mine = heard[group]
        # A suffix behind the first of equal surroundings repeats all of that one's windows.
        behind = (doc != doc[at][group]) | (start != start[at][group])
        mine[behind] = np.uint64(_LAST)
        rows, starts = [], []
        for r in range(gram, span + 1):
            need = span - r
            ok = (mine >> np.uint64(r - gram)) & np.uint64(1) > 0
            ok &= ahead[:, r - 1] > 0
            if need:
                ok &= back[:, need - 1] > 0
            rows.append(row[ok])
            starts.append(start[ok] - need)
        hot = flags.filter(pc.equal(flags["kind"], 1))
        return remove_covered(docs, hot, span, buckets, np.concatenate(rows), np.concatenate(starts))
    return home


RESULT = "doc_id long, n_words long, n_repeated long, spans array<struct<start:long,end:long>>"


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Passages of ``min_words`` words or more that also start earlier in the corpus.

    Returns (doc_id, n_words, n_repeated, spans) for each row: ``spans`` are runs of words, the end
    exclusive, each word of which lies in a window of ``min_words`` words that another document of
    smaller doc_id, or an earlier place of the same one, has too; ``n_repeated`` counts their words.
    The first occurrence is never in a span. Null, empty and short texts have none; a null doc_id
    comes last; rows of one doc_id are the same document; other columns are left behind. Words in
    step 2 are compared by 31 bits of their hash, each word by itself.
    """
    if not 2 <= gram < min_words <= gram + 62:
        raise ValueError("min_words must exceed gram, by 62 at most")
    parts = spread(docs.sparkSession)
    buckets, reach = 2 * parts, min_words - gram + 1
    homes = documents(docs).withColumn("home", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")).repartition(parts, "home")
    flags = (
        homes.groupBy("home").applyInArrow(_send_grams(gram, reach, buckets), "bucket int, home int, codes binary, counts binary")
        .groupBy("bucket").applyInArrow(_match_grams(hot), "home int, bucket int, flags binary")
    )
    seen = written(
        homes.groupBy("home").cogroup(flags.groupBy("home")).applyInArrow(
            _keep_repeated(gram, reach, buckets, min_words), "doc_id long, n_words long, home int, text string, mark binary, cand binary"
        ), "suffixes",
    )
    some = seen.where("text is not null").select("doc_id", "text", "mark", "cand", "home").repartition(parts, "home")
    usual = (
        some.groupBy("home").applyInArrow(
            _send_contexts(gram, min_words, buckets),
            "bucket int, home int, code binary, ahead binary, back binary, doc binary, start binary")
        .groupBy("bucket").applyInArrow(_match_contexts(gram, min_words), "home int, bucket int, flags binary, kind int")
    )
    crowded = (
        some.groupBy("home").applyInArrow(
            send_exact(min_words, buckets), "bucket int, home int, h1 binary, h2 binary, doc binary, start binary")
        .groupBy("bucket").applyInArrow(_match_hot, "home int, bucket int, flags binary, kind int")
    )
    done = some.groupBy("home").cogroup(usual.unionByName(crowded).groupBy("home")).applyInArrow(
        _close(gram, min_words, buckets), RESULT)
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    return seen.where("text is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_repeated"), nothing.alias("spans")).unionByName(done)
