"""DuckDB twins of ``plans/growth.py``."""

from __future__ import annotations

from tokenloom.constants import EOS_ID, UNKNOWN_ID
from tokenloom.plans import queries as q
from tokenloom.plans.growth import PATTERNS
from tokenloom.plans.oracle import DOCS_POS, LABEL_INDEX, MARK, ORACLE as SINGLE, PAT, REC, SHORT_INDEX, TOK, _all_pos, _h, _list_lit

TWO_VERSIONS = f"""WITH {REC},
{TOK},
talk AS (SELECT unnest(regexp_extract_all(text, '{PAT}', 1)) AS token FROM conversations),
c0 AS (SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT token, 1 AS n FROM talk UNION ALL SELECT unnest({_list_lit(MARK)}), 0) GROUP BY token),
v0 AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token ASC) - 1 AS r FROM c0),
c1 AS (SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM tok) GROUP BY token),
v1 AS (SELECT token, n, (SELECT count(*) FROM v0) + row_number() OVER (ORDER BY n DESC, token ASC) - 1 AS r
       FROM c1 WHERE token NOT IN (SELECT token FROM v0)),
v AS (SELECT token, r FROM v0 UNION ALL SELECT token, r FROM v1),
ids AS (SELECT token, CAST(CASE WHEN r < {EOS_ID} THEN r ELSE r + 1 END AS BIGINT) AS id FROM v),
old AS (SELECT token, id AS old_id FROM ids WHERE token IN (SELECT token FROM v0))"""

_EACH = "\nUNION ALL\n".join(f"SELECT doc_id, {k} AS pattern, {_all_pos('t', p)} AS p FROM tok" for k, p in enumerate(PATTERNS))

ORACLE: dict[str, str] = {
    "vocabulary_merge": f"""{TWO_VERSIONS}
SELECT ids.token, CAST(coalesce(c0.n, 0) + coalesce(c1.n, 0) AS BIGINT) AS n, id, old_id
FROM ids LEFT JOIN c0 USING (token) LEFT JOIN c1 USING (token) LEFT JOIN old USING (token)""",

    "find_patterns": f"""WITH {REC},\n{TOK},
each AS ({_EACH})
SELECT doc_id, CAST(pattern AS BIGINT) AS pattern, CAST(len(p) AS BIGINT) AS n_found, array_to_string(p, ',') AS positions
FROM each WHERE len(p) > 0""",

    "bitmap_index": f"""WITH {DOCS_POS},
{SHORT_INDEX}
SELECT file, CAST(row_idx // 32768 AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n_rows,
       md5(string_agg(CAST(row_idx AS VARCHAR), ' ' ORDER BY row_idx)) AS rows_md5
FROM ix GROUP BY file, row_idx // 32768""",

    "bitmap_semi_join": f"""WITH {DOCS_POS},
{LABEL_INDEX},
{SHORT_INDEX}
SELECT file, row_idx, doc_id FROM dp
WHERE EXISTS (SELECT 1 FROM idx WHERE idx.file = dp.file AND idx.row_idx = dp.row_idx)
   OR EXISTS (SELECT 1 FROM ix WHERE ix.file = dp.file AND ix.row_idx = dp.row_idx)""",

    "bitmap_reconcile": SINGLE["reconcile_files"],

    "nested_values": """
SELECT doc_id, doc_id || ',' || n_chars || ',true,' || CAST(-doc_id AS VARCHAR) AS ints,
       doc_id || ',' || n_chars || ',' || source || ',' || lang || ',true,' || CAST(-doc_id AS VARCHAR) AS ints_and_strings
FROM documents""",

    "chunks_once": f"""WITH {REC},\n{TOK}
SELECT CAST(doc_id // {q.CHUNK} AS BIGINT) AS chunk, CAST(min(doc_id) AS BIGINT) AS first, CAST(max(doc_id) AS BIGINT) AS last,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(len(t)) AS BIGINT) AS n_tokens, (doc_id // {q.CHUNK}) % 2 = 1 AS in_second_run,
       CAST(0 AS BIGINT) AS n_rewritten
FROM tok GROUP BY doc_id // {q.CHUNK}""",

    "split_archive": f"""WITH {REC}
SELECT 'all.jsonl.zst' AS file, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_idx, md5(text) AS text_md5 FROM rec""",

    "encode_versions": f"""{TWO_VERSIONS},
tpos AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM tok),
enc AS (SELECT p.doc_id, list(coalesce(o.old_id, {UNKNOWN_ID}) ORDER BY p.pos) AS old, list(i.id ORDER BY p.pos) AS new,
               CAST(count(*) FILTER (WHERE o.old_id IS NULL) AS BIGINT) AS n_learned
        FROM tpos p JOIN ids i USING (token) LEFT JOIN old o USING (token) GROUP BY p.doc_id)
SELECT doc_id, CAST(len(new) AS BIGINT) AS n_ids, {_h('old')} AS old_md5, {_h('new')} AS new_md5, n_learned FROM enc""",
}
