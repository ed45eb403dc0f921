"""DuckDB SQL for the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS n FROM win) WHERE n >= 2),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, ((n_words < 10)::BIGINT
    + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (word_chars < 2 * n_words OR word_chars > 16 * n_words)::BIGINT
    + 16 * (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 32 * (2 * n_marks > n_words)::BIGINT)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
hit AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY key) AS f FROM win) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  SELECT a AS doc_id, b AS r FROM both_ways
  UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON reach.r = a),
low AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.r, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""


def _levels(name: str, count: int) -> str:
    """CTEs ``name0 .. name<count>`` (tree, idx, n, h) from ``name0``, each level of
    runs of three, and for each node what stands left and right of it in its run."""
    out = []
    for j in range(count):
        out.append(f"""{name}{j}s AS (
  SELECT a.tree, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM {name}{j} a JOIN {name}{j} b ON a.tree = b.tree AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.tree, a.idx),
{name}{j + 1} AS (
  SELECT tree, idx // 3 AS idx, (any_value(n) + 2) // 3 AS n,
         CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM {name}{j} GROUP BY tree, idx // 3)""")
    return ",\n".join(out)


def _climb(name: str, start: str, rank: str, count: int, tree: str) -> str:
    """CTEs ``<start>1 ..``: proof so far ``p`` and folded hash ``f`` of every leaf."""
    return ",\n".join(f"""{start}{j + 1} AS (
  SELECT d.* REPLACE (p || coalesce(s.l, '') || coalesce(s.r, '') AS p, CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f)
  FROM {start}{j} d LEFT JOIN {name}{j}s s ON s.tree = {tree} AND s.idx = d.{rank} // {3 ** j})""" for j in range(count))


_DEEP, _WIDE = 13, 7      # levels: 3^13 rows of a source, 3^7 sources
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11 = f"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN (list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) & 1) = 1
              THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS presented
  FROM documents, crc),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM d),
a0 AS (SELECT tree, rank AS idx, count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM ranked),
{_levels('a', _DEEP)},
b0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, h FROM a{_DEEP}),
{_levels('b', _WIDE)},
c0 AS (SELECT *, '' AS p, presented AS f FROM ranked),
{_climb('a', 'c', 'rank', _DEEP, 'd.tree')},
e0 AS (SELECT * FROM c{_DEEP}),
{_climb('b', 'e', 'tree', _WIDE, '0')}
SELECT e.doc_id, e.leaf, a.h AS subroot, b.h AS root, sha256(e.p) AS proof_sha256, e.f AS folded_root, e.f = b.h AS verified
FROM e{_WIDE} e JOIN a{_DEEP} a USING (tree), b{_WIDE} b
"""
