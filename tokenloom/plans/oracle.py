"""DuckDB twins of the registered queries (same column names and types).

DuckDB 2 notes: lambdas are written ``lambda i: ...``; list indexes are
1-based and slices inclusive; ``sum`` of integers is HUGEINT, so every count
is cast to BIGINT; arrays are compared through ``md5(array_to_string(x,' '))``.
"""

from __future__ import annotations

from tokenloom.constants import EOS_ID, IGNORE_LABEL, MARKER, TOKEN_PATTERN
from tokenloom.functions.text import marker_tokens
from tokenloom.plans import queries as q
from tokenloom.plans.records import DIFF_RECORDS_SQL

PAT = TOKEN_PATTERN
MARK = marker_tokens(MARKER)


def _list_lit(items) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + "]"


def _first_pos(arr: str, pattern) -> str:
    """0-based first start of ``pattern`` in list ``arr`` (NULL if none)."""
    m = len(pattern)
    return (f"list_filter(range(len({arr}) - {m - 1}), lambda i: {arr}[i + 1] = '{pattern[0]}' "
            f"AND {arr}[i + 1:i + {m}] = {_list_lit(pattern)})[1]")


def _all_pos(arr: str, pattern) -> str:
    m = len(pattern)
    return (f"list_filter(range(len({arr}) - {m - 1}), lambda i: {arr}[i + 1] = '{pattern[0]}' "
            f"AND {arr}[i + 1:i + {m}] = {_list_lit(pattern)})")


def _h(expr: str) -> str:
    return f"md5(array_to_string({expr}, ' '))"


def _repeat(k: str, v: int) -> str:
    return f"list_resize([]::BIGINT[], {k}, {v})"


def _labels(ids: str, idx: str, cut: int | None = None) -> str:
    tail = f"{ids}[{idx} + 1:]" if cut is None else f"{ids}[{idx} + 1:{cut}]"
    return (f"CASE WHEN {idx} IS NULL THEN [{IGNORE_LABEL}]::BIGINT[] "
            f"ELSE list_concat({_repeat(idx, IGNORE_LABEL)}, {tail}) END")


REC = f"rec AS ({DIFF_RECORDS_SQL})"
TOK = f"tok AS (SELECT doc_id, source, regexp_extract_all(text, '{PAT}', 1) AS t FROM rec)"
VOCAB = f"""vcnt AS (
  SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT unnest(t) AS token, 1 AS n FROM tok
    UNION ALL SELECT unnest({_list_lit(MARK)}) AS token, 0 AS n) GROUP BY token),
vocab AS (
  SELECT token, n, CAST(CASE WHEN r < {EOS_ID} THEN r ELSE r + 1 END AS BIGINT) AS id
  FROM (SELECT token, n, row_number() OVER (ORDER BY n DESC, token ASC) - 1 AS r FROM vcnt))"""
ENC = """tpos AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM tok),
enc AS (SELECT p.doc_id, list(v.id ORDER BY p.pos) AS ids FROM tpos p JOIN vocab v USING (token) GROUP BY p.doc_id)"""
IDX = f"fi AS (SELECT doc_id, source, CAST(len(t) AS BIGINT) AS nt, {_first_pos('t', MARK)} AS dff_idx FROM tok)"
MASKED = f"""m AS (SELECT e.doc_id, e.ids, f.nt, f.dff_idx, {_labels('e.ids', 'f.dff_idx')} AS labels
      FROM enc e JOIN fi f USING (doc_id))"""

BASE = f"WITH {REC},\n{TOK},\n{VOCAB},\n{ENC},\n{IDX}"


def _pack_sql(max_tokens: int, block: int, batch: int, final: str, split: str = "'train'") -> str:
    return _blocks_sql(f"""{BASE},
kept AS (SELECT e.doc_id, e.ids, f.dff_idx FROM enc e JOIN fi f USING (doc_id)
         WHERE f.nt < {max_tokens} AND f.dff_idx IS NOT NULL),
lab AS (SELECT doc_id, ids, {_labels('ids', 'dff_idx')} AS labels, {split} AS split FROM kept)""", block, batch, final)


def _blocks_sql(lab: str, block: int, batch: int, final: str) -> str:
    return f"""{lab},
d AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS dense FROM lab),
b AS (SELECT *, dense // {batch} AS batch_id, len(ids) + 1 AS len1 FROM d),
s AS (SELECT *, CAST(coalesce(sum(len1) OVER (PARTITION BY split, batch_id ORDER BY dense
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS st,
             CAST(sum(len1) OVER (PARTITION BY split, batch_id) AS BIGINT) AS total FROM b),
k AS (SELECT *, least(st + len1, CASE WHEN total >= {block} THEN (total // {block}) * {block}
                                      ELSE total END) AS en FROM s),
x AS (SELECT split, batch_id, st, en, ids, labels,
             unnest(generate_series(st // {block}, (en - 1) // {block})) AS block_id FROM k WHERE en > st),
seg AS (SELECT split, batch_id, block_id, greatest(st, block_id * {block}) AS lo,
               least(en, (block_id + 1) * {block}) AS hi, st,
               list_append(ids, {EOS_ID}) AS ids1,
               list_append({_repeat('len(ids)', 1)}, 0) AS mask1,
               list_append(labels, {IGNORE_LABEL}) AS lab1 FROM x),
blocks AS (SELECT split, batch_id, block_id,
                  flatten(list(ids1[lo - st + 1:hi - st] ORDER BY lo)) AS ids,
                  flatten(list(mask1[lo - st + 1:hi - st] ORDER BY lo)) AS mask,
                  flatten(list(lab1[lo - st + 1:hi - st] ORDER BY lo)) AS labels
           FROM seg GROUP BY split, batch_id, block_id)
{final}"""


_BLOCK_ROWS = f"""SELECT split, CAST(batch_id AS BIGINT) AS batch_id, CAST(block_id AS BIGINT) AS block_id,
       CAST(len(ids) AS BIGINT) AS n_tokens, {_h('ids')} AS ids_md5, {_h('mask')} AS mask_md5,
       {_h('labels')} AS labels_md5 FROM blocks"""

_BLOCK_CHECKS = f"""SELECT split, CAST(count(*) AS BIGINT) AS n_blocks,
       CAST(sum(CASE WHEN len(ids) <> len(mask) OR len(ids) <> len(labels) THEN 1 ELSE 0 END) AS BIGINT) AS len_mismatch,
       CAST(sum(CASE WHEN len(ids) <> {q.PACK_BLOCK} THEN 1 ELSE 0 END) AS BIGINT) AS wrong_size,
       CAST(sum(CASE WHEN labels[1] = {IGNORE_LABEL} THEN 1 ELSE 0 END) AS BIGINT) AS first_label_masked
FROM blocks GROUP BY split"""

DOCS_POS = """dp AS (SELECT doc_id, source AS file, text,
              CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS BIGINT) AS row_idx
       FROM documents)"""
LABEL_INDEX = """idx AS (SELECT file, row_idx FROM dp WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
        UNION ALL
        SELECT file, row_idx FROM dp WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))"""
SHORT_INDEX = f"""ix AS (SELECT file, row_idx FROM dp WHERE len(regexp_extract_all(text, '{PAT}', 1)) < {q.LIMIT_N})"""
ARCHIVE_POS = """rpos AS (SELECT doc_id, source || '.jsonl.zst' AS file,
                CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS BIGINT) AS row_idx FROM rec)"""
PRODUCER = f"""{BASE},
{ARCHIVE_POS},
k AS (SELECT e.doc_id, e.ids, f.dff_idx FROM enc e JOIN fi f USING (doc_id)
      WHERE f.dff_idx IS NOT NULL AND f.nt <= {q.MAX_TOKENS})"""
PRODUCER_ROWS = f"""{PRODUCER}
SELECT p.file, p.row_idx, CAST(len(k.ids[1:{q.MAX_TOKENS}]) AS BIGINT) AS n_ids,
       {_h(f'k.ids[1:{q.MAX_TOKENS}]')} AS ids_md5,
       {_h(_labels('k.ids', 'k.dff_idx', q.MAX_TOKENS))} AS labels_md5
FROM k JOIN rpos p USING (doc_id)"""
FLAGS = f"""{BASE},
fl AS (SELECT doc_id, nt AS n_tokens, dff_idx IS NULL AS without_dff,
              (dff_idx IS NULL OR nt > {q.MAX_TOKENS}) AS invalid FROM fi)"""
COUNTS = """CAST(count(*) AS BIGINT) AS total,
       CAST(sum(CASE WHEN without_dff THEN 1 ELSE 0 END) AS BIGINT) AS without_dff,
       CAST(sum(CASE WHEN invalid THEN 1 ELSE 0 END) AS BIGINT) AS invalid"""
SPLIT_OF = (f"CASE WHEN doc_id < CAST(round_even((SELECT count(*) FROM documents) * {q.PERCENT} / 100.0, 0) "
            "AS BIGINT) THEN 'validation' ELSE 'train' END")
SPLIT = f"""cut AS (SELECT CAST(round_even((SELECT count(*) FROM documents) * {q.PERCENT} / 100.0, 0) AS BIGINT) AS c),
sp AS (SELECT doc_id,
              CASE WHEN doc_id < (SELECT c FROM cut) THEN 'validation' ELSE 'train' END AS split,
              CAST(CASE WHEN doc_id < (SELECT c FROM cut) THEN doc_id ELSE doc_id - (SELECT c FROM cut) END AS BIGINT) AS split_idx
       FROM documents)"""

ORACLE: dict[str, str] = {
    "tokenize_counts": f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, {_h('t')} AS tokens_md5
FROM (SELECT doc_id, regexp_extract_all(text, '{PAT}', 1) AS t FROM documents)""",

    "vocabulary": f"WITH {REC},\n{TOK},\n{VOCAB}\nSELECT token, n, id FROM vocab",

    "encode_ids": f"""{BASE}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, {_h('ids')} AS ids_md5, CAST(len(ids) AS BIGINT) AS mask_sum
FROM enc""",

    "decode_text": f"WITH {REC},\n{TOK}\nSELECT doc_id, {_h('t')} AS decoded_md5 FROM tok",

    "length_filter_strict": f"""WITH {REC},\n{TOK}
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens FROM tok WHERE len(t) < {q.LIMIT_N}""",

    "length_filter_inclusive": f"""WITH {REC},\n{TOK}
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens FROM tok WHERE len(t) <= {q.LIMIT_N}""",

    "truncate_ids": f"""{BASE}
SELECT doc_id, CAST(len(ids[1:{q.TRUNC_N}]) AS BIGINT) AS n_ids, {_h(f'ids[1:{q.TRUNC_N}]')} AS ids_md5,
       CAST(least(len(ids), {q.TRUNC_N}) AS BIGINT) AS n_mask FROM enc""",

    "find_all": f"""WITH {REC},\n{TOK}
SELECT doc_id, CAST(len(p) AS BIGINT) AS n_found, array_to_string(p, ',') AS positions
FROM (SELECT doc_id, {_all_pos('t', q.FIND_PATTERN)} AS p FROM tok)""",

    "find_first": f"""WITH {REC},\n{TOK}
SELECT doc_id, CAST({_first_pos('t', MARK)} AS BIGINT) AS dff_idx FROM tok""",

    "mask_labels": f"""{BASE},
{MASKED}
SELECT doc_id, CAST(dff_idx AS BIGINT) AS dff_idx, CAST(len(labels) AS BIGINT) AS n_labels,
       CAST(len(list_filter(labels, lambda x: x = {IGNORE_LABEL})) AS BIGINT) AS n_masked,
       {_h('labels')} AS labels_md5 FROM m""",

    "flag_records": f"{FLAGS}\nSELECT doc_id, n_tokens, without_dff, invalid FROM fl",

    "quality_counts": f"{FLAGS}\nSELECT {COUNTS} FROM fl",

    "chunk_quality": f"""{FLAGS}
SELECT CAST(doc_id // {q.CHUNK} AS BIGINT) AS chunk, {COUNTS} FROM fl GROUP BY doc_id // {q.CHUNK}""",

    "wraparound_cut": f"""WITH {REC},
laps AS (SELECT doc_id, CAST(doc_id AS BIGINT) AS row_idx, text FROM rec
         UNION ALL SELECT doc_id, CAST(doc_id + (SELECT count(*) FROM rec) AS BIGINT) AS row_idx, text FROM rec),
stop AS (SELECT min(row_idx) AS s FROM laps
         WHERE row_idx > 0 AND row_idx // {q.CHUNK} >= {q.MIN_BATCH}
           AND text IN (SELECT text FROM laps WHERE row_idx = 0))
SELECT row_idx, doc_id FROM laps
WHERE (SELECT s FROM stop) IS NULL OR row_idx < (SELECT s FROM stop)""",

    "pack_blocks": _pack_sql(q.PACK_MAX, q.PACK_BLOCK, q.PACK_BATCH, _BLOCK_ROWS),
    "pack_short_batch": _pack_sql(q.SHORT_MAX, q.SHORT_BLOCK, q.SHORT_BATCH, _BLOCK_ROWS),
    "pack_global": _pack_sql(q.PACK_MAX, q.PACK_BLOCK, 1 << 40, _BLOCK_ROWS),
    "block_checks": _pack_sql(q.PACK_MAX, q.PACK_BLOCK, q.PACK_BATCH, _BLOCK_CHECKS),
    "training_blocks": _pack_sql(
        q.PACK_BLOCK, q.PACK_BLOCK, q.PACK_BATCH, _BLOCK_ROWS,
        split=SPLIT_OF),

    "block_size_large": _pack_sql(
        q.LARGE_BLOCK, q.LARGE_BLOCK, q.PACK_BATCH, _BLOCK_ROWS,
        split=SPLIT_OF),

    "pad_left": f"""{BASE},
kept AS (SELECT e.doc_id, e.ids, f.dff_idx FROM enc e JOIN fi f USING (doc_id)
         WHERE f.nt < {q.PAD_BLOCK} AND f.dff_idx IS NOT NULL),
lab AS (SELECT doc_id, ids, {_labels('ids', 'dff_idx')} AS labels FROM kept)
SELECT doc_id, CAST({q.PAD_BLOCK} AS BIGINT) AS n_ids,
       {_h(f"list_concat({_repeat(f'{q.PAD_BLOCK} - len(ids)', EOS_ID)}, ids)")} AS ids_md5,
       {_h(f"list_concat({_repeat(f'{q.PAD_BLOCK} - len(ids)', 0)}, {_repeat('len(ids)', 1)})")} AS mask_md5,
       {_h(f"list_concat({_repeat(f'{q.PAD_BLOCK} - len(ids)', IGNORE_LABEL)}, labels)")} AS labels_md5
FROM lab""",

    "split_positional": f"WITH {SPLIT}\nSELECT doc_id, split, split_idx FROM sp",

    "sample_cap": f"WITH {SPLIT}\nSELECT doc_id, split FROM sp WHERE split_idx < {q.CAP}",

    "index_filter": f"WITH {DOCS_POS},\n{SHORT_INDEX}\nSELECT file, row_idx FROM ix",

    "index_semi_join": f"""WITH {DOCS_POS},
{LABEL_INDEX}
SELECT file, row_idx, doc_id FROM dp
WHERE EXISTS (SELECT 1 FROM idx WHERE idx.file = dp.file AND idx.row_idx = dp.row_idx)""",

    "reconcile_files": f"""WITH {DOCS_POS},
{LABEL_INDEX},
outp AS (SELECT * FROM dp WHERE EXISTS (SELECT 1 FROM idx WHERE idx.file = dp.file AND idx.row_idx = dp.row_idx)),
i AS (SELECT file, count(*) AS in_rows FROM dp GROUP BY file),
o AS (SELECT file, count(*) AS out_rows FROM outp GROUP BY file),
x AS (SELECT file, count(DISTINCT row_idx) AS index_rows FROM idx GROUP BY file)
SELECT file, CAST(coalesce(in_rows, 0) AS BIGINT) AS in_rows, CAST(coalesce(out_rows, 0) AS BIGINT) AS out_rows,
       CAST(coalesce(index_rows, 0) AS BIGINT) AS index_rows,
       coalesce(out_rows, 0) = least(coalesce(index_rows, 0), coalesce(in_rows, 0)) AS ok
FROM i FULL OUTER JOIN o USING (file) FULL OUTER JOIN x USING (file)""",

    "resume_files": """
SELECT DISTINCT d.source AS file FROM documents d
WHERE d.source IN (SELECT d2.source FROM documents d2 JOIN labels l USING (doc_id) WHERE l.quality = 1)
  AND d.source NOT IN (SELECT d3.source FROM documents d3 JOIN labels l USING (doc_id) WHERE l.toxic = 1)""",

    "index_text": f"""WITH {DOCS_POS},
{SHORT_INDEX}
SELECT file, CAST(row_idx // 1000000 AS BIGINT) AS chunk,
       '[' || string_agg(CAST(row_idx AS VARCHAR), ', ' ORDER BY row_idx) || ']' AS index_text
FROM ix GROUP BY file, row_idx // 1000000""",

    "index_text_roundtrip": f"WITH {DOCS_POS},\n{SHORT_INDEX}\nSELECT file, row_idx FROM ix",

    "argmax_embedding": """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax FROM embeddings""",

    "shifted_accuracy": f"""{BASE},
{MASKED},
acc AS (SELECT CAST(sum(greatest(len(labels) - 1, 0)) AS BIGINT) AS n_positions,
               CAST(sum(len(list_filter(range(greatest(len(labels) - 1, 0)),
                                        lambda i: ids[i + 1] = labels[i + 2]))) AS BIGINT) AS n_correct
        FROM m)
SELECT n_positions, n_correct, round(CAST(n_correct AS DOUBLE) / n_positions, 9) AS accuracy FROM acc""",

    "perplexity": """
WITH l AS (SELECT list_max(embedding)
                  + ln(list_sum(list_transform(embedding, lambda x: exp(x - list_max(embedding)))))
                  - embedding[label + 1] AS loss
           FROM embeddings)
SELECT CAST(count(loss) AS BIGINT) AS n_loss, round(avg(loss), 9) AS mean_loss,
       round(exp(avg(loss)), 6) AS perplexity FROM l""",

    "first_unmasked": f"""{BASE},
{MASKED},
st AS (SELECT doc_id, labels,
              list_filter(range(len(labels)), lambda i: labels[i + 1] <> {IGNORE_LABEL})[1] AS s FROM m)
SELECT doc_id, CAST(s AS BIGINT) AS seg_start,
       CAST(CASE WHEN s IS NULL THEN NULL
                 ELSE coalesce(list_filter(range(s, len(labels)), lambda i: labels[i + 1] = {IGNORE_LABEL})[1],
                               len(labels)) END AS BIGINT) AS seg_end
FROM st""",

    "archive_roundtrip": f"""WITH {REC},
{ARCHIVE_POS}
SELECT p.file, p.row_idx, md5(r.text) AS text_md5 FROM rec r JOIN rpos p USING (doc_id)""",

    "count_files": "SELECT CAST(count(DISTINCT source) AS BIGINT) AS n_files FROM documents",

    "producer_tokens": PRODUCER_ROWS,
    "stream_masked": PRODUCER_ROWS,

    "tfrecord_export": f"""{PRODUCER}
SELECT CAST(len(k.ids) AS BIGINT) AS n_ids, {_h('k.ids')} AS ids_md5 FROM k""",

    "final_table": _pack_sql(q.PACK_MAX, q.PACK_BLOCK, q.PACK_BATCH, """
SELECT split, CAST(count(*) AS BIGINT) AS n_blocks, CAST(sum(len(ids)) AS BIGINT) AS n_tokens
FROM blocks GROUP BY split"""),

    "chunk_files": f"""{BASE},
k AS (SELECT e.doc_id, e.ids, f.dff_idx FROM enc e JOIN fi f USING (doc_id)
      WHERE f.dff_idx IS NOT NULL AND f.nt <= {q.MAX_TOKENS})
SELECT CAST(doc_id // {q.CHUNK} AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
       CAST(sum(len(ids) - dff_idx) AS BIGINT) AS n_unmasked
FROM k GROUP BY doc_id // {q.CHUNK}""",

    "split_files": """
SELECT 'train' AS split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents
UNION ALL
SELECT 'validation' AS split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM conversations""",
}
