"""Language identification by cross-parsing: suffix automata of labelled text.

Each language has the suffix automaton of a bounded sample of its labelled text; it accepts exactly
the substrings of the sample. A document is parsed greedily into longest matches against each
automaton: walk while there is a transition, begin a new phrase where there is none. The language
that needs the fewest phrases for each character wins.

Texts are folded to lower-case letters and single spaces. In the tasks all texts of a chunk are
walked at once, cut every ``SEGMENT`` bytes: one numpy step moves every segment by one byte. The cuts
end no phrase. A segment is walked again from the state that the one before it ended in, until every
segment has begun where its predecessor ended; parses that begin apart soon meet, so this is done
after few rounds.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import column, documents
from tickloom.llm.text import slices, utf8

#: The bounded labelled sample: rows of each language, characters of each row, bytes of each automaton.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_BYTES = 100, 4096, 24_000
#: Bytes of a text that are walked as one.
SEGMENT = 128
NONE = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = _FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def fold(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case (ASCII and Latin-1; other letters as they are), all else as single spaces."""
    out = _FOLD[data]
    if len(data) > 1:
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][latin] += 0x20
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0x20) | (out[:-1] != 0x20)
    begins = at[:-1][at[:-1] < len(out)]
    keep[begins] = True
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[at]


class Automaton:
    """Dense transitions of a suffix automaton: ``table[state + code]`` is the next state, 0 for none.
    States are multiples of ``width``; code 0 is a byte that no sample has."""

    def __init__(self, sample: np.ndarray, codes: np.ndarray, width: int):
        nexts, link, length, last = [{}], [-1], [0], 0
        for c in codes[sample].tolist():
            now = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = now
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    clone = len(nexts)
                    nexts.append(nexts[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nexts[p].get(c) == q:
                        nexts[p][c] = clone
                        p = link[p]
                    link[q] = link[now] = clone
            last = now
        self.table = np.zeros(len(nexts) * width, np.int32)
        for state, to in enumerate(nexts):
            for c, target in to.items():
                self.table[state * width + c] = target * width
        self.root = self.table[:width].copy()

    def walk(self, steps: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in each segment, and the state it ends in; ``steps[i]`` has byte i of all
        segments, longest segments first, ``state`` what each begins in (0: a new phrase)."""
        count, state = np.zeros(len(lengths), np.int32), state.copy()
        active = np.searchsorted(-lengths, -np.arange(1, len(steps) + 1), "right")
        for i in range(len(steps)):
            n = active[i]
            if not n:
                break
            c = steps[i, :n]
            to = self.table[state[:n] + c]
            stuck = to == 0
            # At the root again only after a byte that no match can have: the next one begins a phrase.
            count[:n] += stuck | (state[:n] == 0)
            state[:n] = np.where(stuck, self.root[c], to)
        return count, state

    def phrases(self, steps: np.ndarray, lengths: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Phrases of each segment, of one parse over each whole text. ``after`` is the segment that
        follows each one in its text, -1 at the end."""
        start = np.zeros(len(lengths), np.int32)
        count, end = self.walk(steps, lengths, start)
        follows = np.flatnonzero(after >= 0)
        while True:
            begin = start.copy()
            begin[after[follows]] = end[follows]
            again = np.flatnonzero(begin != start)
            if not len(again):
                return count
            start = begin
            count[again], end[again] = self.walk(steps[:, again], lengths[again], start[again])


def segments(data: np.ndarray, at: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes by step and segment, segment lengths (longest first), each segment's text, and the segment
    that follows it there (-1: none)."""
    size = np.diff(at)
    parts = -(-size // SEGMENT)
    text = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = at[text] + nth * SEGMENT
    length = np.minimum(at[text + 1] - start, SEGMENT)
    order = np.argsort(-length, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    last = nth + 1 == parts[text]
    after = np.where(last, -1, np.append(place[1:], -1) if len(place) else place)[order]
    start, length, text = start[order], length[order], text[order]
    padded = np.concatenate((codes[data], np.zeros(SEGMENT, codes.dtype)))
    return padded[np.arange(SEGMENT)[:, None] + start[None, :]], length, text, after


class Models:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, bytes]):
        folded = {}
        for name, raw in samples.items():
            data = np.frombuffer(raw, np.uint8)
            folded[name] = fold(data, np.array([0, len(data)]))[0][:SAMPLE_BYTES]
        letters = np.unique(np.concatenate([*folded.values(), np.array([0x20], np.uint8)]))
        self.codes = np.zeros(256, np.int32)
        self.codes[letters] = np.arange(1, len(letters) + 1)
        self.names = sorted(folded)
        self.automata = [Automaton(folded[n], self.codes, len(letters) + 1) for n in self.names]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1: one minus best over second-best phrases) of each text."""
        data, at = utf8(texts)
        n = len(at) - 1
        plain = np.isin(data | 0x20, np.arange(0x61, 0x7B)) & (data < 0x80)
        letters = np.diff(np.concatenate(([0], np.cumsum(plain)))[at]) > 0
        for i in np.flatnonzero(~letters & (np.diff(at) > 0)):
            letters[i] = any(c.isalpha() for c in texts[int(i)].as_py())
        if not self.names:
            return [NONE] * n, np.zeros(n)
        steps, length, owner, after = segments(*fold(data, at), self.codes)
        needed = np.stack([np.bincount(owner, a.phrases(steps, length, after), minlength=n) for a in self.automata])
        best = needed.argmin(0)
        ordered = np.sort(needed, 0)
        second = ordered[1] if len(needed) > 1 else np.maximum(ordered[0], 1) * 2
        score = np.where(letters, 1 - ordered[0] / np.maximum(second, 1), 0.0)
        return [self.names[b] if ok else NONE for b, ok in zip(best, letters, strict=True)], score


def learn(labelled: DataFrame) -> Models:
    """Models from (doc_id, text, lang): for each language the first ``SAMPLE_ROWS`` rows in an order
    by hash, ``SAMPLE_CHARS`` characters of each. Rows without text, lang or doc_id are left out."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = (
        labelled.where("text is not null and lang is not null and doc_id is not null")
        .select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS)
        .collect()
    )
    samples: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r["n"]):
        samples.setdefault(r["lang"], []).append(r["text"])
    return Models({lang: "\n".join(texts).encode() for lang, texts in samples.items()})


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text alone.

    ``und`` with score 0 for a null text, a text without a letter, or if no language was learned; of
    languages that need equally many phrases the first by name. Repeated rows and null doc_ids stay;
    other columns are left behind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            names, score = shared.value.predict(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return documents(docs).mapInArrow(rows, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame) -> F.Column:
    """crc32 of the id as text leaves 2 by 4; false for a null id."""
    return F.coalesce(F.crc32(column("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, then predict all: (doc_id, held_out, lang_pred, score)."""
    models = learn(documents(docs, "lang").where(~held_out(docs)))
    return identify(docs, models).withColumn("held_out", held_out(docs)).select("doc_id", "held_out", "lang_pred", "score")
