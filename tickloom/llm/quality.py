"""Quality rules from the suffix array of each document's words.

The suffix array of all texts of a chunk is built at once by prefix doubling in numpy: suffixes of
different texts never share a rank, and only suffixes whose rank is not unique yet are sorted again.
The ranks of each level give the longest common prefix of neighbours. For a suffix, the larger of
the two neighbouring values is the longest substring starting there that the text has elsewhere;
these are the maximal repeated substrings, whose spans are united.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.frames import documents, map_rows
from tickloom.llm.text import SEPARATOR, Words, hash_spans, mix, slices

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class Limits:
    """Base: fewest words, window and percentage of repeated words. Method: maximal repeats of at
    least ``span`` words may cover at most ``covered`` of the words, and none may have more than
    ``longest`` words."""

    min_words: int = 10
    window: int = 5
    repeat_percent: int = 20
    span: int = 10
    covered: float = 0.2
    longest: int = 99


def longest_repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the words of the longest substring starting there that its text has at another place."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    end = np.repeat(first[1:], np.diff(first))
    key = mix(hashes ^ mix(doc + np.uint64(1)))
    order = np.argsort(key)
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    alone = new & np.concatenate((new[1:], [True]))
    active = order[~alone]
    array = order
    while len(active):
        ahead = active + step
        second = np.where(ahead < end[active], rank[np.minimum(ahead, n)], -1)
        by = np.lexsort((second, rank[active]))
        active, second = active[by], second[by]
        group = rank[active]
        fresh = np.concatenate(([True], group[1:] != group[:-1]))
        at = np.flatnonzero(fresh)
        place = np.arange(len(active)) - np.repeat(at, np.diff(np.append(at, len(active)))) + group
        array[place] = active
        cut = fresh | np.concatenate(([True], second[1:] != second[:-1]))
        head = np.maximum.accumulate(np.where(cut, np.arange(len(active)), 0))
        rank[active] = place[head]
        levels.append(rank.copy())
        lone = cut & np.concatenate((cut[1:], [True]))
        active, step = active[~lone], step * 2
    left, right = array[:-1].copy(), array[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for size, ranks in sorted(((1 << i, r) for i, r in enumerate(levels)), key=lambda x: -x[0]):
        same = (ranks[left] == ranks[right]) & (ranks[left] >= 0)
        common += same * size
        left = np.minimum(left + same * size, n)
        right = np.minimum(right + same * size, n)
    best = np.zeros(n, np.int64)
    best[array[1:]] = common
    best[array[:-1]] = np.maximum(best[array[:-1]], common)
    return best


def covered_words(best: np.ndarray, least: int) -> np.ndarray:
    """Flags of the words in the union of repeated substrings of at least ``least`` words."""
    n = len(best)
    at = np.flatnonzero(best >= least)
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    edge -= np.bincount(at + best[at], minlength=n + 1)[: n + 1]
    return np.cumsum(edge[:-1]) > 0


def _by_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])


def _most(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest value of each text; 0 for one without words."""
    out = np.zeros(len(first) - 1, np.int64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.maximum.reduceat(values, first[:-1][full])
    return out


def duplicate_lines(words: Words) -> np.ndarray:
    """Lines (between \\n) of each text that have a word and equal an earlier line of it."""
    data, at = words.data, words.at
    n = len(at) - 1
    if len(data) == 0:
        return np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate((at[:-1], breaks + 1)))
    start = start[start < len(data)]
    end = np.minimum(np.append(start[1:], len(data)), len(data))
    end = end - (data[end - 1] == 10)
    seen = np.concatenate(([0], np.cumsum(~SEPARATOR[data])))
    full = seen[end] > seen[start]
    start, end = start[full], end[full]
    doc = np.searchsorted(at, start, "right") - 1
    line = hash_spans(data, start, end)
    kinds = np.unique(np.stack([doc.astype(np.uint64), line]), axis=1)[0].astype(np.int64)
    return np.bincount(doc, minlength=n) - np.bincount(kinds, minlength=n)


def _measure(limits: Limits):
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            words = Words.of(batch.column(1))
            count = words.count
            best = longest_repeats(words.hashes(), words.first)
            repeated = _by_text(covered_words(best, limits.window), words.first)
            spans = _by_text(covered_words(best, limits.span), words.first)
            longest = _most(best, words.first)
            failed = (count < limits.min_words) | (100 * repeated > limits.repeat_percent * count)
            kept = ~failed & (spans <= limits.covered * count) & (longest <= limits.longest)
            yield pa.record_batch(
                [batch.column(0)]
                + [pa.array(x.astype(np.int64)) for x in (count, words.chars(), _by_text(_SYMBOL[words.data], words.at),
                                                          duplicate_lines(words), repeated)]
                + [pa.array(failed), pa.array(kept)]
                + [pa.array(x.astype(np.int64)) for x in (spans, longest)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                 "n_span_words", "longest_repeat"],
            )
    return rows


MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_span_words long, longest_repeat long"
)


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text), over whole texts.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines, n_repeat_words (words in
    windows that the text has twice), base_failed, kept, n_span_words (words in maximal repeats of
    ``span`` words or more) and longest_repeat (words). A null text counts as empty and fails; a
    null doc_id stays null; repeated rows are judged alone; other columns are left behind. A single
    text is handled in one piece, about 150 bytes of memory for each of its bytes.
    """
    return documents(docs).mapInArrow(_measure(limits), MEASURES)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; no join and no shuffle."""
    names = docs.columns
    text, doc_id = names.index("text"), names.index("doc_id")

    def rows(batches: Iterable[pa.RecordBatch]):
        judge = _measure(limits)
        for batch in slices(batches, str(text)):
            part = pa.record_batch([batch.column(doc_id), batch.column(text)], ["doc_id", "text"])
            verdict = pa.concat_arrays([b.column(7) for b in judge([part])])
            yield batch.filter(verdict)

    return map_rows(docs, rows)
