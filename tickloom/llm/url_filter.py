"""URL filter: a sorted array of 64-bit digests, memory-mapped, probed by vectorised binary search.

``DigestArray`` holds strings with a small code each: digests in rising order, then the full
strings. A probe finds the digest by binary search over the whole batch and then compares the
stored string, so that a collision of digests never decides. The file lies in the shared folder
and reaches the executors through ``addFile``; every worker of an executor maps the same copy.

Rules are ``host/path`` strings. A rule fits its host and all subdomains, if the path of the url
starts with the path of the rule. The longest fitting rule wins, of two of one length the one with
the longer host. Hosts are probed first, label by label; only the path lengths that rules of that
host have are probed after that.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.frames import column, written
from tickloom.session import scratch_path

#: Entries of one memory-mapped array, about 100 bytes each; a longer list is dealt out by its hosts
#: and probed part by part.
ENTRIES = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class DigestArray:
    """Strings with a code, in a file: count, digests, codes, offsets, bytes."""

    def __init__(self, path: str):
        n = int(np.memmap(path, np.int64, "r", shape=1)[0]) if os.path.getsize(path) else 0
        self.keys = np.memmap(path, np.uint64, "r", 8, n) if n else np.zeros(0, np.uint64)
        self.codes = np.memmap(path, np.int64, "r", 8 + 8 * n, n) if n else np.zeros(0, np.int64)
        self.at = np.memmap(path, np.int64, "r", 8 + 16 * n, n + 1) if n else np.zeros(1, np.int64)
        self.blob = np.memmap(path, np.uint8, "r", 16 + 24 * n) if n else np.zeros(0, np.uint8)

    @staticmethod
    def build(entries: dict[bytes, int], digest=xxhash.xxh64_intdigest) -> bytes:
        """The contents of the file."""
        order = sorted((digest(text), text) for text in entries)
        return b"".join([
            np.int64(len(order)).tobytes(), np.array([d for d, _ in order], np.uint64).tobytes(),
            np.array([entries[text] for _, text in order], np.int64).tobytes(),
            np.cumsum([0, *(len(text) for _, text in order)], dtype=np.int64).tobytes(),
            b"".join(text for _, text in order) or b"\0",
        ])

    def string(self, i: int) -> bytes:
        return self.blob[self.at[i] : self.at[i + 1]].tobytes()

    def find(self, texts: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """Position of each text, or -1."""
        wanted = np.fromiter((digest(t) for t in texts), np.uint64, len(texts))
        low, high = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        found = np.full(len(texts), -1, np.int64)
        for i in np.flatnonzero(low < high):
            found[i] = next((p for p in range(low[i], high[i]) if self.string(p) == texts[i]), -1)
        return found


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    if not slash:
        raise ValueError(f"a rule is host/path: {rule!r}")
    return host, slash + path


def _ship(spark: SparkSession, name: str, data: bytes) -> str:
    """Put a file into the shared folder and have every executor fetch it; its name there."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


class _Judge:
    """The probing side in a worker."""

    arrays: dict[str, tuple[DigestArray, DigestArray]] = {}

    def __init__(self, hosts: str, rules: str, lengths: list[tuple[int, ...]], names: list[tuple[str, str]], default: str):
        self.files, self.lengths, self.names, self.default = (hosts, rules), lengths, names, default

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        key = self.files[0]
        if key not in self.arrays:
            self.arrays[key] = tuple(DigestArray(SparkFiles.get(f)) for f in self.files)
        hosts, rules = self.arrays[key]
        for batch in batches:
            yield self.judge(batch, hosts, rules)

    def judge(self, batch: pa.RecordBatch, hosts: DigestArray, rules: DigestArray) -> pa.RecordBatch:
        """The best entry of each row, of these entries and what the row already has."""
        names, paths = batch.column(1).to_pylist(), [p.encode() for p in batch.column(2).to_pylist()]
        labels = {}
        for name in set(names):
            parts = name.encode().split(b".")
            labels[name] = [b".".join(parts[i:]) for i in range(len(parts))]
        tails = list(dict.fromkeys(t for ts in labels.values() for t in ts))
        known = {t: self.lengths[hosts.codes[p]] for t, p in zip(tails, hosts.find(tails), strict=True) if p >= 0}
        rows, probes = [], []
        for i, (name, path) in enumerate(zip(names, paths, strict=True)):
            for tail in labels[name]:
                for length in known.get(tail, ()):
                    if length <= len(path):
                        rows.append(i)
                        probes.append(tail + path[:length])
        best: dict[int, tuple] = {}
        for i, (rule, verdict, listed) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True)):
            if rule is not None or listed is not None:
                best[i] = _rank(rule if rule is not None else listed, "list" if rule is None else "rule", verdict)
        for i, text, p in zip(rows, probes, rules.find(probes), strict=True):
            if p >= 0:
                rank = _rank(text.decode(), *self.names[rules.codes[p]])
                best[i] = max(best.get(i, rank), rank)
        hits = [best.get(i) for i in range(len(names))]
        return pa.record_batch([
            *batch.columns[:3],
            pa.array([h[3] if h and h[5] == "rule" else None for h in hits], pa.string()),
            pa.array([h[4] if h else self.default for h in hits], pa.string()),
            pa.array([h[3] if h and h[5] == "list" else None for h in hits], pa.string()),
        ], ["id", "host", "path", "rule", "verdict", "listed"])


def _rank(text: str, source: str, verdict: str) -> tuple:
    """Rules go before the list, then the longer entry, then the one with the longer host."""
    return source == "rule", len(text), len(text.encode().partition(b"/")[0]), text, verdict, source


def _arrays(spark: SparkSession, entries: dict[str, tuple[str, str]], default: str) -> _Judge:
    """The entries {host/path: (source, verdict)} as files that every executor maps."""
    lengths: dict[str, set[int]] = defaultdict(set)
    for text in entries:
        host, path = _split(text)
        lengths[host].add(len(path.encode()))
    kinds, names = sorted({tuple(sorted(x)) for x in lengths.values()}), sorted(set(entries.values()))
    place = {k: i for i, k in enumerate(kinds)}
    return _Judge(
        _ship(spark, "hosts", DigestArray.build({h.encode(): place[tuple(sorted(x))] for h, x in lengths.items()})),
        _ship(spark, "rules", DigestArray.build({t.encode(): names.index(x) for t, x in entries.items()})), kinds, names, default,
    )


def _parts(listed: Iterable[str] | DataFrame, entries: int) -> Iterable[list[str]]:
    """The list in parts of about so many entries; a table's parts are read one after another."""
    if not isinstance(listed, DataFrame):
        rest = list(dict.fromkeys(listed))
        yield from (rest[i : i + entries] for i in range(0, len(rest), entries))
        return
    own = written(listed.select(column("entry").cast("string").alias("entry")).where("entry is not null").distinct(), "listed")
    n = -(-own.count() // entries)
    for part in range(n):
        yield [r["entry"] for r in own.where(F.pmod(F.xxhash64("entry"), F.lit(n)) == part).toLocalIterator()]


def judge_urls(
    pages: DataFrame, rules: dict[str, str], listed: Iterable[str] | DataFrame = (), *,
    id_col: str = "page_id", url_col: str = "url", default: str = "allow", entries: int = ENTRIES,
) -> DataFrame:
    """Judge every url: (id, host, path, rule, verdict, listed).

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. ``listed`` has host/path strings that are
    blocked where no rule fits, as strings or as a table with a column ``entry`` (null ones and repeated
    ones don't count). A url that neither fits gets ``default``; so does a null url, a url without
    ``://`` and an empty host. ``rule`` and ``listed`` name the deciding entry, else null. Repeated rows
    and null ids stay, each row judged alone; other columns of ``pages`` are left behind. A list of more
    than ``entries`` is probed in parts, in one pass over the rows: each part keeps the best entry yet.
    """
    spark = pages.sparkSession
    parts = pages.select(
        column(id_col).alias("id"), url_host(column(url_col)).alias("host"), url_path(column(url_col)).alias("path"),
        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(None).cast("string").alias("listed"),
    )
    schema = f"id {parts.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string, listed string"
    own: dict[str, tuple[str, str]] = {text: ("rule", v) for text, v in rules.items()}
    judged = False
    for some in _parts(listed, entries):
        known = {text: ("list", "block") for text in some} | own
        parts, judged = parts.mapInArrow(_arrays(spark, known, default), schema), True
    if not judged:
        parts = parts.mapInArrow(_arrays(spark, own, default), schema)
    return parts.withColumnRenamed("id", id_col)
