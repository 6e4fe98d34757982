"""DuckDB SQL of the operators that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


_WORDS_1 = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORDS_4 = r"'[^\x20\x09-\x0D]+'"

OP1 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_folded('text')}, {_WORDS_1}) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all({_folded('text')}, {_WORDS_1}) AS w FROM benchmark)
  WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[j:j + k - 1], ' ') AS win
  FROM (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS j FROM b)),
widths AS (SELECT DISTINCT k FROM windows),
starts AS (
  SELECT doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j
        FROM d, widths WHERE len(w) >= k)),
found AS (
  SELECT s.doc_id, s.j, s.k, x.item FROM starts s JOIN windows x ON s.k = x.k AND s.win = x.win),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM (SELECT DISTINCT doc_id, j, k FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS_4}) AS w FROM documents),
starts AS (
  SELECT doc_id, j, array_to_string(w[j:j + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS j FROM d WHERE len(w) >= 13)),
first AS (SELECT win, min(doc_id) AS least FROM starts GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(range(j, j + 13)) AS p
        FROM starts JOIN first USING (win) WHERE least < doc_id)),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
  ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

_WORDS_11 = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(CAST(lang AS VARCHAR), '') AS lang,
         coalesce(CAST(source AS VARCHAR), '') AS source,
         regexp_extract_all({_folded('text')}, {_WORDS_11}) AS w FROM documents),
t AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
      FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS lang_n FROM t GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS (SELECT g.lang, g.source, k.term, k.lang_n, CAST(coalesce(t.n, 0) AS HUGEINT) AS n
      FROM g JOIN k USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n,
             CAST(1 + 1000000000 * (c.n + 1) // (s.total + v.v) AS HUGEINT) AS p,
             CAST(1 + 1000000000 * (c.lang_n + 1) // (v.lang_total + v.v) AS HUGEINT) AS q
      FROM c JOIN s USING (lang, source) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT l.lang, l.source, r.source AS item, sum((l.p - r.p) * (l.p - r.p) // r.p) AS value
             FROM p l JOIN p r ON l.lang = r.lang AND l.term = r.term AND l.source <> r.source
             GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (
  SELECT *, length(role) + length(text) + 15          -- '### ', ':' and line feed, line feed and '</turn>', line feed
    + length(role || text) - length(replace(role || text, '\', ''))
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + length(text) - length(regexp_replace(text, '#+', '#', 'g'))
    + (length(role) - length(replace(role, '</turn>', ''))) // 7
    + length(role) - length(regexp_replace(role, '#+', '#', 'g'))
    + length(role) - length(replace(role, chr(10), '')) AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


def _op13(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Every round is a distance of every part to every entry of its position."""
    def nearest(books: str) -> str:
        return f"""
  SELECT vec_id, label, part, w, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d
  FROM (SELECT p.r, p.vec_id, p.label, p.part, p.w, b.entry,
               list_sum(list_transform(range(1, len(p.w) + 1),
                                       lambda i: (p.w[i] - b.w[i]) * (p.w[i] - b.w[i]))) AS d
        FROM p JOIN {books} b USING (part))
  GROUP BY r, vec_id, label, part, w"""

    steps = [f"""
v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS r, vec_id, label, e
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
p AS (
  SELECT r, vec_id, label, part, e[part * len(e) // {parts} + 1:(part + 1) * len(e) // {parts}] AS w
  FROM (SELECT *, unnest(range({parts})) AS part FROM v)),
b0 AS (SELECT part, r AS entry, w FROM p WHERE r < {entries})"""]
    for i in range(1, rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED ({nearest(f'b{i - 1}')}),
m{i} AS (
  SELECT part, entry, list(x ORDER BY place) AS w
  FROM (SELECT part, entry, place, CAST(floor_div AS BIGINT) AS x
        FROM (SELECT part, entry, place,
                     (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
              FROM (SELECT part, entry, unnest(w) AS x, unnest(range(len(w))) AS place FROM a{i})
              GROUP BY part, entry, place))
  GROUP BY part, entry),
b{i} AS MATERIALIZED (
  SELECT part, entry, coalesce(m{i}.w, b{i - 1}.w) AS w FROM b{i - 1} LEFT JOIN m{i} USING (part, entry))""")
    return f"""
WITH {','.join(steps)},
z AS MATERIALIZED ({nearest(f'b{rounds}').replace('SELECT vec_id', 'SELECT r, vec_id', 1)}),
c AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
         CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY r, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM c
"""


ORACLE: dict[str, str] = {
    "op1_benchmark_decontamination": OP1,
    "op4_substring_dedup": OP4,
    "op6_exact_top_k_search": OP6,
    "op11_source_divergence_audit": OP11,
    "op12_chat_formatting": OP12,
    "op13_vector_code_compression": _op13(),
}
