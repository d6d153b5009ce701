"""Ranked search, vector codes and piece encoding against brute force and the library."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from tests.llm.cases import odd_docs, odd_rows, planted
from tickloom.llm import pieces, ranked_search, vector_codes
from tickloom.llm.queries import PIECES

ROWS = planted()
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --- 11 ranked search

def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n_docs, length = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in tfs:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


ITEMS = [
    (0, ROWS[0][1]), (1, ROWS[1][1] + " " + ROWS[0][1][:200]), (2, "ka KA ka lo mi"), (2, "ka lo mi"), (None, "vo nu, dra"), (3, None), (4, "--- ..."),
    (5, "ka lo mi ren"), (6, "mi ren tas unheard-of"), (7, "ünïcödé texts"), (8, "ka lo mi"),
]


@pytest.mark.parametrize(("k", "broadcast", "block"), [(50, 64 << 20, 30_000), (3, 1, 10), (1, 2000, 40)])
def test_search_equals_brute_force(spark, monkeypatch, k, broadcast, block):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    docs = [*ROWS, (7, ROWS[3][1]), (None, ROWS[0][1]), (None, ROWS[0][1]), (200, None), (201, "ÜNÏCÖDÉ Texts"), (202, "")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, n long, terms int").repartition(5)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, block string")
    got = ranked_search.search(frame, items, k=k, broadcast_bytes=broadcast)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, ITEMS, k)


def test_search_of_empty_tables_and_odd_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = odd_docs(spark)
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs.limit(0), items).count() == 0
    got = sorted((tuple(r) for r in ranked_search.search(docs, items).collect()), key=repr)
    assert got == brute_search([r[:2] for r in odd_rows()], ITEMS, 50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12))
def test_shared_sums_add_up(items):
    n = 31
    levels, rows = ranked_search.share([np.array(sorted(i)) for i in items], n)
    plan = ranked_search.Plan(
        [None] * len(items), np.arange(n), [tuple(np.array(level).T) for level in levels],
        np.concatenate(rows).astype(np.int64), np.cumsum([0, *map(len, rows)])[:-1],
    )
    values = np.random.default_rng(1).integers(0, 1000, (n, 7))
    assert (plan.scores(values) == np.stack([values[sorted(i)].sum(0) for i in items])).all()


def test_shared_sets_save_additions():
    rng = random.Random(4)
    common = list(range(25))
    items = [np.array(sorted({*(c for c in common if rng.random() < 0.8), *(25 + rng.randrange(300) for _ in range(5))})) for _ in range(60)]
    levels, rows = ranked_search.share(items, 325)
    assert sum(map(len, levels)) + sum(map(len, rows)) < 0.75 * sum(map(len, items))
    same = [np.arange(40)] * 9
    _, rows = ranked_search.share(same, 40)
    assert [len(r) for r in rows] == [1] * 9


# --- 12 vector codes

def brute_codes(rows, entries=256, parts=4, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), i) for i, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            groups = defaultdict(list)
            for c, best in zip(cut, near, strict=True):
                groups[best[p][1]].append(c[p])
            for e, own in groups.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total, out = defaultdict(int), []
    for (i, _, label), best in zip(kept, assign(), strict=True):
        total[label] += sum(d for d, _ in best)
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    return sorted(((i, code, error, total[label], digest) for i, code, error, label in out), key=repr)


def vectors(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, np.round(rng.normal(size=dims), 1).tolist(), int(rng.integers(4)) if i % 5 else None) for i in range(n)]


KIND = "vec_id long, embedding array<double>, label int, part int, `a.b` int"


@pytest.mark.parametrize(("n", "entries"), [(180, 16), (30, 256), (1, 256)])
def test_codes_equal_brute_force(spark, n, entries):
    rows = vectors(n) + [(3, [0.5] * 16, None), (None, [0.25] * 16, 1), (None, [0.25] * 16, 1)]
    bad = [(900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf"), *[0.0] * 15], 2), (904, [], 1), (905, [1.0] * 3, 1)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows + bad], KIND).repartition(4)
    got = vector_codes.compress(frame, entries=entries).drop("label")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_codes(rows, entries)


def test_codes_of_odd_tables(spark):
    empty = spark.createDataFrame([], KIND)
    assert vector_codes.compress(empty).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, 1, 1)], KIND)).collect() == []
    # A length that four does not divide, and components that no long could hold.
    rows = [(i, [1e300 * (i - 2), -1e300, float(i), 0.5, 2.0], 7, 0, 0) for i in range(5)]
    got = vector_codes.compress(spark.createDataFrame(rows, KIND), entries=2).collect()
    assert len(got) == 5 and all(0 <= r["error"] < 1 << 63 for r in got)


@pytest.mark.parametrize("scale", [1, 3, 400, 10**8])
def test_pivots_find_the_nearest_entry(scale):
    rng = np.random.default_rng(scale)
    rows, entries = (rng.integers(-scale, scale + 1, (n, 6)) for n in (700, 90))
    pivots = vector_codes.choose_pivots(entries)
    index, error, tried = vector_codes.nearest(rows, vector_codes.to_pivots(rows, pivots), entries, pivots)
    d = vector_codes.squared(rows[:, None], entries[None])
    assert (index == d.argmin(1)).all() and (error == d.min(1)).all()
    assert tried <= d.size * 1.1
    close = entries[rng.integers(0, 90, 500)] + rng.integers(0, 2, (500, 6))
    if scale > 100:
        _, _, tried = vector_codes.nearest(close, vector_codes.to_pivots(close, pivots), entries, pivots)
        assert tried < 500 * 90 * 0.25


# --- 13 pieces

@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


TEXT = st.lists(st.sampled_from([*"ab the1 2  ▁\n\t\x00éß日本\U0001f600́ﬁ①�", "  ", "the", "<s>", "<unk>", "<0x41>", "x" * 70])).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXT | st.text())
def test_pieces_equal_the_library(own, library, text):
    (ids, borders), = own.encode([text])
    want = library.encode(text, return_type="proto")
    assert ids.tolist() == [p.id for p in want.pieces]
    assert list(zip(borders[:-1], borders[1:], strict=True)) == [(p.begin, p.end) for p in want.pieces]
    assert own.decode(ids) == library.decode(ids.tolist())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 259, 260, 29871, *range(195, 205), *range(261, 300)]) | st.integers(0, 31999), max_size=9))
def test_any_ids_decode_as_in_the_library(own, library, ids):
    assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf"])
@pytest.mark.parametrize("flags", range(8))
def test_normalising_by_a_compiled_map(rule, flags):
    how = {"add_dummy_prefix": bool(flags & 1), "remove_extra_whitespaces": bool(flags & 2), "escape_whitespaces": bool(flags & 4)}
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **how)
    model = ModelProto()
    model.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    for name, value in how.items():
        setattr(model.normalizer_spec, name, value)
    normalize, rng = pieces.Normalizer(model.normalizer_spec), random.Random(flags)
    letters = [*"ab T1 2  ▁\n\t\x00éß日\U0001f600́ﬁ①ÀÅ　​㌕가İſ\xa0", "ｶﾞ", "  ", "À", "<s>"]
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        want, places = library.normalize(text, with_offsets=True)
        data, origin = normalize(text)
        assert data.decode() == want
        source = np.cumsum([0, *(len(c.encode()) for c in text)])
        ends = np.cumsum([0, *(len(c.encode()) for c in want)])
        assert origin[ends].tolist() == [source[p] for p in places]


def test_long_texts_are_encoded_in_parts(own, library, monkeypatch):
    monkeypatch.setattr(pieces, "PART", 50)
    monkeypatch.setattr(pieces, "REMEMBER", 40)
    texts = [t for _, t in ROWS] + ["a" * 500, "  ".join(["deep", "water"] * 60), "", "▁▁" * 80, "é▁ " * 60]
    got = own.encode(texts)
    assert [ids.tolist() for ids, _ in got] == library.encode(texts)
    for text, (_, borders) in zip(texts, got, strict=True):
        assert borders[0] == 0 and borders[-1] == len(text.encode()) and (np.diff(borders) >= 0).all()


def test_encode_and_decode_tables(spark, library):
    docs = odd_docs(spark)
    texts = Counter((r[0], r[1] or "") for r in odd_rows())
    encoded = pieces.encode(docs, PIECES)
    rows = encoded.collect()
    assert Counter((r["doc_id"], library.decode(r["ids"])) for r in rows) == texts
    assert {tuple(r["ids"]) for r in rows} == {tuple(library.encode(t)) for _, t in texts}
    assert Counter((r["doc_id"], r["text"]) for r in pieces.decode(encoded, PIECES).collect()) == texts
    assert pieces.encode(docs.limit(0), PIECES).count() == pieces.digests(docs.limit(0), PIECES).count() == 0
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((d, len(ids := library.encode(t)), sha(",".join(map(str, ids))), sha(library.decode(ids)), len(t.encode())) for d, t in texts.elements())
    assert Counter((r[0], r[1], r[2], r[3], r["n_bytes"]) for r in pieces.digests(docs, PIECES).collect()) == want
