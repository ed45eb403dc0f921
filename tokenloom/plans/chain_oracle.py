"""DuckDB twins of ``plans/chains.py``."""

from __future__ import annotations

from tokenloom.constants import EOS_ID, IGNORE_LABEL
from tokenloom.plans import queries as q
from tokenloom.plans.oracle import (ARCHIVE_POS, BASE, FLAGS, IDX, MARK, ORACLE as SINGLE, PAT, REC, SPLIT, SPLIT_OF, TOK,
                                    _BLOCK_ROWS, _blocks_sql, _h, _labels, _list_lit, _pack_sql, _repeat)

LAB = f"""{BASE},
lab AS (SELECT doc_id, e.ids, {_labels('e.ids', 'f.dff_idx')} AS labels, {SPLIT_OF} AS split
        FROM enc e JOIN fi f USING (doc_id) WHERE f.nt < {q.PACK_BLOCK} AND f.dff_idx IS NOT NULL)"""

PADDED = f"""{LAB}
SELECT split, doc_id, CAST({q.PACK_BLOCK} AS BIGINT) AS n_ids,
       {_h(f"list_concat({_repeat(f'{q.PACK_BLOCK} - len(ids)', EOS_ID)}, ids)")} AS ids_md5,
       {_h(f"list_concat({_repeat(f'{q.PACK_BLOCK} - len(ids)', 0)}, {_repeat('len(ids)', 1)})")} AS mask_md5,
       {_h(f"list_concat({_repeat(f'{q.PACK_BLOCK} - len(ids)', IGNORE_LABEL)}, labels)")} AS labels_md5
FROM lab"""

def _decoded(ids: str) -> str:
    return (f"(SELECT md5(coalesce(string_agg(v.token, ' ' ORDER BY p.pos), '')) FROM "
            f"(SELECT unnest({ids}) AS id, unnest(range(len({ids}))) AS pos FROM one) p JOIN vocab v USING (id))")


ORACLE: dict[str, str] = {
    "archive_to_blocks": _blocks_sql(f"""{BASE},
{ARCHIVE_POS},
g AS (SELECT row_number() OVER (ORDER BY p.file, p.row_idx) - 1 AS doc_id, e.ids, f.dff_idx
      FROM enc e JOIN fi f USING (doc_id) JOIN rpos p USING (doc_id)
      WHERE f.dff_idx IS NOT NULL AND f.nt <= {q.MAX_TOKENS}),
lab AS (SELECT doc_id, ids, {_labels('ids', 'dff_idx')} AS labels,
               CASE WHEN doc_id < round_even((SELECT count(*) FROM g) * {q.PERCENT} / 100.0, 0)
                    THEN 'validation' ELSE 'train' END AS split
        FROM g WHERE len(ids) < {q.PACK_BLOCK})""", q.PACK_BLOCK, q.PACK_BATCH, _BLOCK_ROWS),

    "resume_tokenized": PADDED,
    "force_label": SINGLE["training_blocks"],
    "pad_training": PADDED,

    "skip_concat": f"""{LAB}
SELECT split, doc_id, CAST(len(ids) AS BIGINT) AS n_ids, {_h('ids')} AS ids_md5,
       {_h(_repeat('len(ids)', 1))} AS mask_md5, {_h('labels')} AS labels_md5 FROM lab""",

    "split_train_only": SINGLE["training_blocks"],

    "first_sample": _pack_sql(q.PACK_BLOCK, q.PACK_BLOCK, q.PACK_BATCH, f""", f AS (SELECT * FROM blocks WHERE split = 'train' ORDER BY batch_id, block_id LIMIT 1),
b0 AS (SELECT *, list_filter(range(len(labels)), lambda i: labels[i + 1] <> {IGNORE_LABEL})[1] AS st FROM f),
b1 AS (SELECT *, coalesce(list_filter(range(st, len(labels)), lambda i: labels[i + 1] = {IGNORE_LABEL})[1], len(labels)) AS en FROM b0),
one AS (SELECT *, labels[st + 1:en] AS seg FROM b1)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(block_id AS BIGINT) AS block_id, CAST(st AS BIGINT) AS seg_start,
       CAST(en AS BIGINT) AS seg_end, {_decoded('ids')} AS decoded_md5, {_decoded("seg")} AS segment_md5 FROM one""", SPLIT_OF),

    "cap_after_pack": _pack_sql(q.PACK_BLOCK, q.PACK_BLOCK, q.PACK_BATCH,
                                _BLOCK_ROWS + f" QUALIFY row_number() OVER (PARTITION BY split ORDER BY batch_id, block_id) <= {q.CAP}",
                                SPLIT_OF),

    "marker_counts": f"""{FLAGS},
{SPLIT}
SELECT split, CAST(sum(CASE WHEN without_dff THEN 1 ELSE 0 END) AS BIGINT) AS without_dff
FROM fl JOIN sp USING (doc_id) GROUP BY split""",

    "split_summary": f"WITH {SPLIT}\nSELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM sp GROUP BY split",

    "stream_new_tokens": f"""WITH {REC},
{TOK},
{IDX},
{ARCHIVE_POS},
talk AS (SELECT DISTINCT token FROM (SELECT unnest(regexp_extract_all(text, '{PAT}', 1)) AS token FROM conversations
         UNION ALL SELECT unnest({_list_lit(MARK)}))),
late AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(t) AS token FROM tok) WHERE token NOT IN (SELECT token FROM talk) GROUP BY doc_id),
every AS (SELECT CAST(count(DISTINCT token) AS BIGINT) AS n FROM (SELECT token FROM talk UNION ALL SELECT unnest(t) FROM tok))
SELECT p.file, p.row_idx, CAST(len(t) AS BIGINT) AS n_ids, CAST(coalesce(l.n, 0) AS BIGINT) AS n_new, CAST(0 AS BIGINT) AS n_unknown,
       {_h('t')} AS decoded_md5, (SELECT n FROM every) AS n_vocabulary, (SELECT n FROM every) AS n_vocabulary_ids
FROM tok JOIN fi f USING (doc_id) JOIN rpos p USING (doc_id) LEFT JOIN late l USING (doc_id)
WHERE f.dff_idx IS NOT NULL AND f.nt <= {q.MAX_TOKENS}""",

    "two_pass_filter": f"""WITH {REC},
{ARCHIVE_POS}
SELECT p.file, CAST(row_number() OVER (PARTITION BY p.file ORDER BY p.row_idx) - 1 AS BIGINT) AS row_idx, md5(r.text) AS text_md5
FROM rec r JOIN rpos p USING (doc_id) WHERE len(regexp_extract_all(r.text, '{PAT}', 1)) < {q.LIMIT_N}""",

    "tfrecord_strict": f"""{BASE}
SELECT CAST(len(e.ids) AS BIGINT) AS n_ids, {_h('e.ids')} AS ids_md5, CAST(count(*) OVER () AS BIGINT) AS n_exported
FROM enc e JOIN fi f USING (doc_id) WHERE f.nt < {q.MAX_TOKENS}""",

    "named_table": "SELECT doc_id, md5(text) AS text_md5 FROM documents",

    "text_lines": """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT k AS keep_linebreaks, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(length(line) + CASE WHEN k THEN 1 ELSE 0 END) AS BIGINT) AS n_chars
FROM l, (SELECT unnest([true, false]) AS k) GROUP BY k""",

    "user_functions": f"SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents WHERE length(text) > {q.LIMIT_N}",
}
