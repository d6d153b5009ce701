"""DuckDB SQL for the rows of the queries that SQL can express.

Secrets, packing, language identification and LM scoring depend on trained models or a tokenizer;
their queries are tested against brute force, round trips and held-out rows instead.
"""

from __future__ import annotations

from tickloom.llm.queries import LISTED, RULES

_WORDS = r"""words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"""


def _windows(size: int) -> str:
    """Windows of ``size`` words: their words joined, and where they start (from 1)."""
    return f"""SELECT doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS g
  FROM words, unnest(range(1, len(w) - {size - 2})) AS t(i) WHERE len(w) >= {size}"""


def _entries() -> str:
    every = [("list", t, "block") for t in LISTED if t not in RULES] + [("rule", t, v) for t, v in RULES.items()]
    return ", ".join(f"('{source}', '{text}', '{verdict}')" for source, text, verdict in every)


_URLS = rf"""WITH parts AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
entries AS (SELECT source, entry, verdict, split_part(entry, '/', 1) AS h, substr(entry, instr(entry, '/')) AS p
  FROM (VALUES {_entries()}) AS v(source, entry, verdict)),
best AS (SELECT page_id, arg_max({{'source': source, 'entry': entry, 'verdict': verdict}},
    (CASE source WHEN 'rule' THEN 1 ELSE 0 END, length(entry), length(h))) AS b
  FROM parts JOIN entries ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, CASE WHEN b.source = 'rule' THEN b.entry END AS rule,
  coalesce(b.verdict, 'allow') AS verdict, CASE WHEN b.source = 'list' THEN b.entry END AS listed
FROM parts LEFT JOIN best USING (page_id)"""

_SHINGLES = f"""shingles AS (SELECT DISTINCT doc_id, g FROM ({_windows(5)})
  UNION SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4)"""

_JACCARD = f"""WITH RECURSIVE {_WORDS}, {_SHINGLES},
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE pairs.n >= 0.8 * (x.n + y.n - pairs.n) - 1e-9),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS class_id, (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links
FROM documents d"""

_CONTAINED = f"""WITH {_WORDS}, docs AS (SELECT DISTINCT doc_id, g FROM ({_windows(5)})),
item_words AS (SELECT item_id AS doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
items AS (SELECT DISTINCT doc_id AS item_id, g FROM ({_windows(5).replace('FROM words', 'FROM item_words')})),
sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (g) GROUP BY ALL) JOIN sizes USING (item_id)
WHERE n_shared >= 0.8 * n_item - 1e-9"""


def _removed(size: int) -> str:
    """CTEs: every word with its place, and whether a window that starts earlier elsewhere covers it."""
    return f"""{_WORDS}, windows AS ({_windows(size)}),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range({size}) AS r(k)),
every AS (SELECT doc_id, i, w[i] AS word, c.i IS NOT NULL AS gone
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words) p LEFT JOIN covered c USING (doc_id, i))"""


_SUBSTRINGS = f"""WITH {_removed(20)}
SELECT d.doc_id, count(e.i) AS n_words, count(e.i) FILTER (e.gone) AS n_removed,
  sha256(coalesce(string_agg(e.word, ' ' ORDER BY e.i) FILTER (NOT e.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN every e USING (doc_id) GROUP BY d.doc_id"""

_PASSAGES = f"""WITH {_removed(50)},
islands AS (SELECT doc_id, min(i) - 1 AS a, max(i) AS b FROM (
  SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM every WHERE gone) GROUP BY doc_id, island),
told AS (SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS spans, CAST(sum(b - a) AS BIGINT) AS n FROM islands GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_repeated, coalesce(spans, '') AS spans FROM words LEFT JOIN told USING (doc_id)"""


def _repeated(size: int, name: str) -> str:
    return f"""{name} AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM ({_windows(size)})), range({size}) AS r(k) WHERE times > 1 GROUP BY doc_id)"""


_QUALITY = f"""WITH {_WORDS}, {_repeated(5, 'five')}, {_repeated(10, 'ten')}, {_repeated(100, 'hundred')},
lines AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS dups FROM (SELECT doc_id, line, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL) GROUP BY doc_id),
measured AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
  coalesce(five.n, 0) AS n_repeat_words, coalesce(ten.n, 0) AS n_span_words, hundred.n IS NULL AS short_repeats
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN five USING (doc_id) LEFT JOIN ten USING (doc_id) LEFT JOIN hundred USING (doc_id)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_span_words <= 0.2 * n_words AND short_repeats AS kept, n_span_words FROM failed"""


def _terms(table: str, key: str) -> str:
    return rf"""SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM {table}"""


_RANKED = f"""WITH tf AS (SELECT doc_id, t, count(*) AS tf FROM ({_terms('documents', 'doc_id')}) GROUP BY ALL),
docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM docs),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY t, n_docs),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // l)))) AS BIGINT) AS score
  FROM (SELECT DISTINCT item_id, t FROM ({_terms('benchmark', 'item_id')})) JOIN weights USING (t) JOIN tf USING (t) JOIN docs USING (doc_id), whole
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50"""


def _codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """The rounds written out: each assigns every part to its nearest entry and takes the floored means."""
    steps = [f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
  list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT r, p, min({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y), 'e': e}}) AS b
  FROM parts JOIN book{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (SELECT p, e, list(m ORDER BY i) AS m FROM (
  SELECT p, b.e AS e, i, floor(sum(x[i]) / count(*)) AS m FROM near{k} JOIN parts USING (r, p), unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p, b.e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, y) AS y FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    return f"""WITH {', '.join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', CAST(b.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS BIGINT), ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(y) AS c, unnest(range(len(y))) AS i FROM book{rounds})) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


ORACLES: dict[str, str] = {
    "op1_url_filter": _URLS,
    "op2_jaccard_join": _JACCARD,
    "op3_decontaminate": _CONTAINED,
    "op6_substring_dedup": _SUBSTRINGS,
    "op8_quality": _QUALITY,
    "op10_suffix_dedup": _PASSAGES,
    "op11_ranked_search": _RANKED,
    "op12_vector_codes": _codes(),
}
