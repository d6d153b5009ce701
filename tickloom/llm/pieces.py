"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest prefix that
the map knows is replaced, any other character stays. Each byte of the normalised text remembers the
source byte that its replacement began at. The vocabulary then segments the normalised text, and
every piece is projected through that alignment to the bytes of the text that it came from.

The character map is a double-array trie over UTF-8 bytes, followed by its replacements. Segmenting
is left to the library, with the model's own normaliser switched off, so it sees what this module has
normalised. In BPE vocabularies no merge crosses the border before a space mark, if no piece does:
the units between such borders are segmented once each and remembered.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.frames import documents
from tickloom.llm.text import slices

SPACE = "▁"
#: Distinct units that a worker remembers, characters of a remembered unit, and characters of a text
#: that are segmented at once.
REMEMBER, UNIT, PART = 400_000, 64, 1 << 20
_BPE, _NORMAL = 2, (1, 4)
_CUT = re.compile(f"[^{SPACE}](?={SPACE})")


class CharacterMap:
    """Longest-prefix lookup in a compiled character map; an empty map knows nothing."""

    def __init__(self, compiled: bytes):
        if compiled:
            size = int.from_bytes(compiled[:4], "little")
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
            self.replacements = compiled[4 + size :]
        else:
            self.units, self.replacements = [], b""
        #: Bytes that a rule may begin with.
        self.first = frozenset(b for b in range(256) if self.units and self._walk(bytes([b]), 0)[0])

    def _walk(self, data: bytes, at: int) -> tuple[int, int, int]:
        """How many bytes are a way into the trie; length and value of the longest rule on it."""
        units = self.units
        node, length, value, n = units[0] >> 10 << ((units[0] & 512) >> 6), 0, -1, at
        while n < len(data):
            node ^= data[n]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[n]:
                break
            n += 1
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                length, value = n - at, units[node] & 0x7FFFFFFF
        return n - at, length, value

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Bytes of the longest known prefix at ``at`` (0: none) and what replaces it."""
        _, length, value = self._walk(data, at)
        return (length, self.replacements[value : self.replacements.index(b"\0", value)]) if length else (0, b"")


class Normalizer:
    """Normalised text and its alignment; ``spec`` is the normalizer_spec of a model."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        first = bytes(sorted(self.map.first))
        self.rule = re.compile(b"[" + re.escape(first) + b"]") if first else None

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Longest-prefix replacement; the start of its source for each byte."""
        raw = np.frombuffer(data, np.uint8)
        own = np.arange(len(raw))
        # Bytes of a character that stays begin where it does.
        starts = np.maximum.accumulate(np.where(raw & 0xC0 != 0x80, own, 0)) if len(raw) else own
        if self.rule is None:
            return data, starts
        out, origin, done = [], [], 0
        found = self.rule.search(data)
        while found:
            at = found.start()
            length, new = self.map.longest(data, at)
            if length:
                out += [data[done:at], new]
                origin += [starts[done:at], np.full(len(new), at)]
                done = at + length
            found = self.rule.search(data, done if length else at + 1)
        out.append(data[done:])
        origin.append(starts[done:])
        return b"".join(out), np.concatenate(origin)

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised UTF-8 bytes, and for each of them, and for the end, the source byte."""
        data = text.encode()
        new, origin = self._mapped(data)
        flat, end = np.frombuffer(new, np.uint8), len(data)
        blank = flat == 0x20
        if self.squeeze and len(flat):
            # One space between words, none at the ends.
            full = np.flatnonzero(~blank)
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]
            keep[: full[0] if len(full) else len(flat)] = False
            if len(full):
                if full[-1] + 1 < len(flat):
                    end = int(origin[full[-1] + 1])
                keep[full[-1] + 1 :] = False
            flat, origin, blank = flat[keep], origin[keep], blank[keep]
        if not len(flat):
            return b"", np.zeros(1, np.int64)
        lead = int(origin[0]) if self.squeeze else 0
        mark = SPACE.encode() if self.escape else b" "
        new = flat.tobytes()
        if self.escape:
            new = new.replace(b" ", mark)
            origin = np.repeat(origin, np.where(blank, len(mark), 1))
            if self.squeeze:
                # Marks that were in the text end it no more than blanks do.
                stop = len(new)
                while new.endswith(mark, 0, stop):
                    stop -= len(mark)
                if stop < len(new):
                    new, origin, end = new[:stop], origin[:stop], int(origin[stop])
        if self.dummy:
            new, origin = mark + new, np.concatenate((np.full(len(mark), lead), origin))
        return new, np.append(origin, end)


class Pieces:
    """Encoding and decoding by the model file at ``path``."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        model = ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.normalize = Normalizer(model.normalizer_spec)
        if model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models that change the text after decoding are not supported")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with the space at the end of a word are not supported")
        names = [p.piece for p in model.pieces]
        kinds = [p.type for p in model.pieces]
        own = model.normalizer_spec
        self.strip, self.strip_all = own.add_dummy_prefix or own.remove_extra_whitespaces, own.remove_extra_whitespaces
        self.byte = {i: int(n[3:5], 16) for i, (n, kind) in enumerate(zip(names, kinds, strict=True)) if kind == 6}
        self.fallback = bool(model.trainer_spec.byte_fallback)
        self.unknown = kinds.index(2)
        #: What a piece is in a decoded text, and how many bytes of the normalised text it takes.
        self.surface = [
            "" if kind == 3 else model.trainer_spec.unk_surface if kind == 2 else name.replace(SPACE, " ")
            for name, kind in zip(names, kinds, strict=True)
        ]
        self.first_blank = [kind in _NORMAL and name.startswith(SPACE) for name, kind in zip(names, kinds, strict=True)]
        self.width = np.array([1 if kind == 6 else len(name.encode()) for name, kind in zip(names, kinds, strict=True)], np.int64)
        # The library segments what this class has normalised.
        own.precompiled_charsmap = b""
        own.add_dummy_prefix = own.remove_extra_whitespaces = own.escape_whitespaces = False
        self.library = SentencePieceProcessor(model_proto=model.SerializeToString())
        plain = [n for n, kind in zip(names, kinds, strict=True) if kind in _NORMAL]
        self.in_units = (
            model.trainer_spec.model_type == _BPE and self.fallback and 4 not in kinds
            and all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", n) for n in plain)
        )
        self.units = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.known: dict[str, bytes] = {}
        self.told = list(map(str, range(len(names))))

    def _segment(self, units: list[str]) -> list[bytes]:
        return [array("i", ids).tobytes() for ids in self.library.encode(units, num_threads=1)]

    def _raw(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts of moderate length, as 32-bit integers."""
        if not self.in_units:
            return self._segment(texts)
        units = list(map(self.units, texts))
        found = [list(map(self.known.get, own)) for own in units]
        new = {u for own, ids in zip(units, found, strict=True) if None in ids for u, x in zip(own, ids, strict=True) if x is None}
        if new:
            if len(self.known) + len(new) > REMEMBER:
                self.known.clear()
            # One call for all that is new; the library takes long to begin one.
            new = list(new)
            fresh = dict(zip(new, self._segment(new), strict=True))
            self.known.update((u, x) for u, x in fresh.items() if len(u) <= UNIT)
            found = [
                [fresh[u] if x is None else x for u, x in zip(own, ids, strict=True)] if None in ids else ids
                for own, ids in zip(units, found, strict=True)
            ]
        return list(map(b"".join, found))

    def _ids(self, texts: list[str]) -> list[bytes]:
        short = [t for t in texts if len(t) <= PART]
        done = iter(self._raw(short)) if short else iter(())
        return [next(done) if len(t) <= PART else b"".join(self._raw([p])[0] for p in self._parts(t)) for t in texts]

    def _parts(self, text: str) -> Iterator[str]:
        """A long normalised text, cut where no piece reaches across."""
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + PART) if self.in_units else None
            stop = cut.end() if cut else len(text)
            yield text[at:stop]
            at = stop

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text the ids, and the borders of the pieces in the source: piece i came from the
        bytes borders[i] to borders[i + 1]."""
        normal = [(data.decode(), origin) for data, origin in map(self.normalize, texts)]
        out = []
        for (text, origin), raw in zip(normal, self._ids([n for n, _ in normal]), strict=True):
            ids = np.frombuffer(raw, np.int32)
            if self.fallback or not (ids == self.unknown).any():
                width = self.width[ids]
            else:
                width = np.array([len(p.encode()) for p in self.library.encode(text, out_type=str)], np.int64)
            out.append((ids, origin[np.concatenate(([0], np.cumsum(width)))]))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids: byte pieces in a row are read as UTF-8, wrong bytes become U+FFFD,
        and the space mark that normalising put before the text is left out."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        out, blank_seen = [], False
        for at, i in enumerate(ids):
            if i in self.byte or blank_seen or any(out):
                ids = ids[at:]
                break
            text = self.surface[i]
            # The mark before the text: once, or each of them where normalising removes blanks.
            if self.strip and self.first_blank[i]:
                text, blank_seen = text[1:], not self.strip_all
            out.append(text)
        else:
            ids = []
        if self.byte.keys().isdisjoint(ids):
            out += map(self.surface.__getitem__, ids)
            return "".join(out)
        for is_byte, run in groupby(ids, self.byte.__contains__):
            if is_byte:
                out.append(read_utf8(bytes(map(self.byte.__getitem__, run))))
            else:
                out += map(self.surface.__getitem__, run)
        return "".join(out)


def read_utf8(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is not part of a character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append("�")
        at += n
    return "".join(out)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, starts, ends) of every row: piece i came from the bytes starts[i] to ends[i] of the text.

    A mark that normalising adds has an empty span; of a character that falls back to bytes, the last
    byte has its span. Null and empty texts have no pieces. Rows that repeat a doc_id, or have none,
    stay; other columns are left behind.
    """
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in slices(batches):
            done = pieces.encode([t or "" for t in batch.column(1).to_pylist()])
            at = pa.array(np.concatenate(([0], np.cumsum([len(ids) for ids, _ in done]))).astype(np.int32))
            parts = [np.concatenate(p).astype(np.int32) for p in zip(*((ids, b[:-1], b[1:]) for ids, b in done), strict=True)]
            yield pa.record_batch([batch.column(0), *(pa.ListArray.from_arrays(at, pa.array(p)) for p in parts)], ["doc_id", "ids", "starts", "ends"])

    return documents(docs).mapInArrow(rows, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids are an empty text."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([pieces.decode(i or ()) for i in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, n_bytes long"


def digests(docs: DataFrame, path: str) -> DataFrame:
    """What ``encode`` and ``decode`` give, as digests: one row for each row of ``docs``.

    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256`` over the decoded text,
    ``spans_sha256`` over the pieces' ends in the source as little-endian 64-bit integers; ``n_bytes``
    is what the spans cover.
    """
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in slices(batches):
            out = []
            for ids, borders in pieces.encode([t or "" for t in batch.column(1).to_pylist()]):
                own = ids.tolist()
                told = (",".join(map(pieces.told.__getitem__, own)), pieces.decode(own))
                out.append((len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in told),
                            hashlib.sha256(borders[1:].astype("<i8").tobytes()).hexdigest(), int(borders[-1] - borders[0])))
            yield pa.record_batch([batch.column(0), *map(pa.array, zip(*out, strict=True))], [c.split()[0] for c in DIGESTS.split(", ")])

    return documents(docs).mapInArrow(rows, DIGESTS)
