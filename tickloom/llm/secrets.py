"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

Two first-order models over the characters of tokens are trained from labelled samples: random
strings (values that the fixed patterns found, and generated strings over the usual alphabets)
against ordinary identifiers (all other token characters of the corpus). Training counts character
pairs of every whole text in the tasks; two small count tables are all that is gathered. A token of
``MIN_TOKEN`` characters or more is a secret if the log-likelihood ratio of the models is at least
``PER_CHAR`` for each character on average.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import column, documents, map_rows
from tickloom.llm.text import runs, slices, utf8

# The base kinds, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_TOKEN, PER_CHAR = 20, 1.5
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Generated samples: strings of each alphabet, their length, and the seed.
SAMPLES, SAMPLE_LENGTH, SEED = 2000, 40, 11
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", CHARACTERS[:62], CHARACTERS)

_N = len(CHARACTERS) + 1
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(CHARACTERS.encode(), np.uint8)] = np.arange(1, _N)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and not overlapping for each kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def pair_counts(codes: np.ndarray) -> np.ndarray:
    """How often each pair of token characters occurs in a row."""
    both = (codes[:-1] > 0) & (codes[1:] > 0)
    return np.bincount((codes[:-1] * _N + codes[1:])[both], minlength=_N * _N)


def _codes(text: str) -> np.ndarray:
    return _CODE[np.frombuffer(text.encode(), np.uint8)]


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of each pair of characters."""

    ratio: np.ndarray

    @classmethod
    def fit(cls, random: np.ndarray, ordinary: np.ndarray) -> Models:
        def logs(counts: np.ndarray) -> np.ndarray:
            table = counts.reshape(_N, _N).astype(np.float64)
            # A first letter rarely seen leans on the model's overall letter shares.
            share = (table.sum(0) + 1) / (table.sum() + _N)
            return np.log((table + 20 * share) / (table.sum(1, keepdims=True) + 20))

        return cls(logs(random) - logs(ordinary))

    def score(self, token: str) -> float:
        """Mean log-likelihood ratio of the token's pairs."""
        codes = _codes(token)
        return float(self.ratio[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """All spans: the base ones, and tokens beside them that the models call random."""
        base = base_spans(text)
        more = [
            (m.start(), 3, m.end()) for m in _TOKEN.finditer(text)
            if not any(a < m.end() and m.start() < b for a, _, b in base) and self.score(m[0]) >= PER_CHAR
        ]
        return sorted(base + more)


def _suspects(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the bytes of all texts with a gap between texts, and which rows may have a secret."""
    data, at = utf8(batch.column(1))
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    codes = np.zeros(len(data) + n, np.int64)
    codes[np.arange(len(data)) + doc] = _CODE[data]
    start, end = runs(codes > 0)
    long = start[end - start >= MIN_TOKEN]
    marked = np.zeros(n, bool)
    marked[np.searchsorted(at[1:] + np.arange(1, n + 1), long, "right")] = True
    marked[doc[(data == ord(":")) | (data == ord("="))]] = True
    return codes, marked


def _train(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    random, ordinary = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
    for batch in slices(batches):
        codes, marked = _suspects(batch)
        at = utf8(batch.column(1))[1]
        for i in np.flatnonzero(marked):
            text = batch.column(1)[i].as_py()
            own = codes[at[i] + i : at[i + 1] + i]
            done = 0
            for start, kind, end in base_spans(text):
                # Of an assignment, the value is the sample; of overlapping spans the first.
                value = _ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
                random += pair_counts(_codes(value)) if start >= done else 0
                done = max(done, end)
                first = len(text[:start].encode())
                own[first : first + end - start] = 0
        # Tokens long enough to be judged have no label.
        start, end = runs(codes > 0)
        for a, b in zip(*(x[end - start >= MIN_TOKEN] for x in (start, end)), strict=True):
            codes[a:b] = 0
        ordinary += pair_counts(codes)
    yield pa.record_batch([pa.array(np.arange(_N * _N)), pa.array(random), pa.array(ordinary)], ["pair", "random", "ordinary"])


def generated() -> np.ndarray:
    """Pair counts of the generated labelled strings."""
    rng = np.random.default_rng(SEED)
    total = np.zeros(_N * _N, np.int64)
    for letters in ALPHABETS:
        codes = _CODE[np.frombuffer(letters.encode(), np.uint8)]
        for row in rng.choice(codes, (SAMPLES, SAMPLE_LENGTH)):
            total += pair_counts(row)
    return total


def train(docs: DataFrame) -> Models:
    """Both models from every whole text of ``docs``; without any text, from the generated strings alone."""
    counts = (
        documents(docs).mapInArrow(_train, "pair long, random long, ordinary long")
        .groupBy("pair").agg(F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary"))
        .where("random + ordinary > 0").collect()
    )
    random, ordinary = generated(), np.zeros(_N * _N, np.int64)
    # Values of one pattern must not outweigh the generated alphabets.
    seen = np.zeros(_N * _N)
    for pair, r, o in counts:
        seen[pair], ordinary[pair] = r, o
    if seen.sum():
        random = random + seen * min(1.0, random.sum() / len(ALPHABETS) / seen.sum())
    return Models.fit(np.asarray(random), ordinary)


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(models: Models):
    empty = hashlib.sha256(b"").hexdigest()

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches):
            _, marked = _suspects(batch)
            n = batch.num_rows
            counts = np.zeros((3, n), np.int64)
            digest, told = [empty] * n, [""] * n
            for i in np.flatnonzero(marked):
                spans = models.spans(batch.column(1)[i].as_py())
                base = [s for s in spans if s[1] < 3]
                for s in base:
                    counts[s[1], i] += 1
                digest[i], told[i] = hashlib.sha256(_told(base).encode()).hexdigest(), _told(spans)
            yield pa.record_batch(
                [batch.column(0), *map(pa.array, counts), pa.array(digest), pa.array(told)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )
    return rows


def find_secrets(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """Spans of every row: (doc_id, n_assign, n_access, n_hex, base_sha256, spans).

    ``spans`` is ``kind:start:end`` by start, then kind, in code points, the end exclusive; the
    method's own kind is ``random``. A null text is empty and has none; a null doc_id stays null;
    repeated rows are scanned apart; other columns are left behind.
    """
    models = models or train(docs)
    return documents(docs).mapInArrow(
        _scan(models), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(docs: DataFrame, models: Models | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The same rows with every secret of ``text`` replaced; ``n_chars``, if there, counts the new text.

    Overlapping spans are replaced as one. Rows without a secret are unchanged.
    """
    models = models or train(docs)
    names = docs.columns
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names else None
    id_at = names.index("doc_id")

    def clean(text: str) -> str:
        out, end = [], 0
        for a, _, b in models.spans(text):
            if a >= end:
                out += [text[end:a], mark]
            end = max(end, b)
        return "".join(out) + text[end:]

    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in slices(batches, str(at)):
            _, marked = _suspects(pa.record_batch([batch.column(id_at), batch.column(at)], ["doc_id", "text"]))
            if marked.any():
                texts = batch.column(at).to_pylist()
                new = {i: c for i in np.flatnonzero(marked) if (c := clean(texts[i])) != texts[i]}
                columns = list(batch.columns)
                columns[at] = pa.array([new.get(i, t) for i, t in enumerate(texts)], batch.schema.field(at).type)
                if size is not None:
                    sizes = batch.column(size).to_pylist()
                    columns[size] = pa.array([len(new[i]) if i in new else s for i, s in enumerate(sizes)], batch.schema.field(size).type)
                batch = pa.record_batch(columns, schema=batch.schema)
            yield batch

    kept = docs.select([column(n).cast("string").alias(n) if n == "text" else column(n) for n in names])
    return map_rows(kept, rows)
