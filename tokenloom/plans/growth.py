"""Registered queries over what grows: vocabularies with versions, archives of
many frames, patterns searched together.  The twins are in ``growth_oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.bitmaps import BUCKET_ROWS, bitmap_index, keep_in_bitmaps, positions, reconcile_bitmaps, unite
from tokenloom.operators.nested import INTS, INTS_AND_STRINGS, flatten_nested
from tokenloom.operators.patterns import find_patterns
from tokenloom.operators.rowindex import chunk_id
from tokenloom.operators.vocab import with_tokens
from tokenloom.operators.vocab_store import VocabularyStore, open_vocabulary, token_counts
from tokenloom.plans import queries as q
from tokenloom.plans.flows import index_filter_pass1
from tokenloom.plans.records import diff_records, documents, table
from tokenloom.session import land, scratch_path
from tokenloom.sinks.archive import write_archive
from tokenloom.sinks.chunk_manifest import manifest, read_chunks, write_chunks_once
from tokenloom.sources.files import read_archive

FRAME_BYTES = 1 << 18    # small, so that a small table has many frames
PATTERNS = [["."], [".", "<"], ["<", "DFF", ">"], ["%", "%"], ["%", "%", "%"], ["<", "BEF"], [">", "."], ["%"] * 200, ["the", "the"]]


def _two_versions(spark: SparkSession, sf: str) -> tuple[VocabularyStore, DataFrame]:
    """Version 0 from the conversations, version 1 from the diff records."""
    talk = with_tokens(table(spark, sf, "conversations").select("text")).select("tokens")
    store = open_vocabulary(spark, scratch_path(spark, "vocabulary"), token_counts(talk), "conversations")
    records = land(q._records_tokens(spark, sf), "tokens")
    store.merge(token_counts(records), "documents")
    store.merge(token_counts(records), "documents")      # merged already: nothing changes
    return store, records


def q_vocabulary_merge(spark, sf):
    """A8 over two inputs: old ids stay, new tokens are appended, counts add up."""
    store, _ = _two_versions(spark, sf)
    old = store.table(0).select("token", F.col("id").alias("old_id"))
    return store.read().join(old, "token", "left").select("token", "n", "id", "old_id")


def q_encode_versions(spark, sf):
    """J4 with both versions: an old table's ids are a prefix of the new one's."""
    store, records = _two_versions(spark, sf)
    t = records.select("doc_id", "tokens")
    old, new = (store.encode(t, ["doc_id"], v, with_mask=False, landed=True) for v in (0, 1))
    both = old.select("doc_id", F.col("input_ids").alias("old")).join(new.select("doc_id", F.col("input_ids").alias("new")), "doc_id")
    return both.select("doc_id", q.n_of("new").alias("n_ids"), q.h("old").alias("old_md5"), q.h("new").alias("new_md5"),
                       q.n_of(F.filter(F.zip_with("old", "new", lambda x, y: x == y), lambda same: ~same)).alias("n_learned"))


def q_find_patterns(spark, sf):
    """F7 for several patterns in one pass: nested, periodic and long ones."""
    found = find_patterns(q._records_tokens(spark, sf).select("doc_id", "tokens"), PATTERNS)
    each = found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.pattern", "m.start")
    return each.groupBy("doc_id", "pattern").agg(
        F.count(F.lit(1)).alias("n_found"), F.array_join(F.array_sort(F.collect_list("start")), ",").alias("positions")).select(
        "doc_id", F.col("pattern").cast("bigint").alias("pattern"), "n_found", "positions")


def q_split_archive(spark, sf):
    """K5 and S1 with all records in one archive: compressed and read by many
    tasks, frame by frame; positions as in the file."""
    path = scratch_path(spark, "one-archive")
    rec = diff_records(spark, sf).withColumn("file", F.lit("all.jsonl.zst"))
    write_archive(rec, path, file_col="file", order_col="doc_id", frame_bytes=FRAME_BYTES)
    return read_archive(spark, path).select("file", "row_idx", F.md5("text").alias("text_md5"))


def q_bitmap_index(spark, sf):
    """K8 as bitmaps: the short records of every file, listed twice, set once."""
    index = index_filter_pass1(q._docs_with_position(spark, sf), q.LIMIT_N)
    b = bitmap_index(index.unionAll(index))
    bits = positions(b).groupBy("file", F.floor(F.col("row_idx") / BUCKET_ROWS).alias("bucket")).agg(
        F.sort_array(F.collect_list("row_idx")).alias("rows"))
    return b.select("file", (F.col("bucket") - 1).cast("bigint").alias("bucket"), F.bitmap_count("bitmap").alias("n_rows")).join(
        bits, ["file", "bucket"]).select("file", "bucket", "n_rows", q.h("rows").alias("rows_md5"))


def q_bitmap_semi_join(spark, sf):
    """J1 by bitmaps: rows that the label index or the index of short records lists."""
    docs = q._docs_with_position(spark, sf)
    index = unite(bitmap_index(q._label_index(spark, sf, docs)), bitmap_index(index_filter_pass1(docs, q.LIMIT_N)))
    return keep_in_bitmaps(docs.select("file", "row_idx", "doc_id"), index)


def q_bitmap_reconcile(spark, sf):
    """A3 from bitmaps of the rows in, out and listed."""
    docs = q._docs_with_position(spark, sf)
    index = bitmap_index(q._label_index(spark, sf, docs))
    return reconcile_bitmaps(bitmap_index(docs), bitmap_index(keep_in_bitmaps(docs, index)), index)


def q_nested_values(spark, sf):
    """F12 over nested JSON of every document, with both rules."""
    d = documents(spark, sf).select("doc_id", "n_chars", "source", "lang")
    text = F.format_string('[%s, [[%s, null, "%s"], 1.5, []], {"a": [9]}, [[["%s"]], true, [-%s]]]',
                           F.col("doc_id").cast("string"), F.col("n_chars").cast("string"), F.col("source"), F.col("lang"), F.col("doc_id").cast("string"))
    lists = land(d.select("doc_id", text.alias("text")), "lists")
    ints = flatten_nested(lists, ["doc_id"], "text", INTS)
    both = flatten_nested(lists, ["doc_id"], "text", INTS_AND_STRINGS, "all")
    return ints.join(both, "doc_id").select("doc_id", F.array_join("elements", ",").alias("ints"), F.array_join("all", ",").alias("ints_and_strings"))


def q_chunks_once(spark, sf):
    """K3 with a manifest: half of the chunks first, then all; the second call
    writes what is missing, and the manifest tells each chunk's range."""
    t = q._records_tokens(spark, sf).select(F.col("doc_id").alias("row_idx"), q.n_of("tokens").alias("n_tokens"), chunk_id("doc_id", q.CHUNK).alias("batch"))
    t = land(t, "chunks")
    path = scratch_path(spark, "chunks-once")
    first = write_chunks_once(t.where(F.col("batch") % 2 == 0), path)
    second = write_chunks_once(t, path)
    sums = read_chunks(spark, path).groupBy(F.col("batch").cast("bigint").alias("chunk")).agg(F.sum("n_tokens").alias("n_tokens"))
    late = F.col("chunk").isin(second) if second else F.lit(False)
    again = F.lit(len(set(first) & set(second)))
    return manifest(spark, path).join(sums, "chunk").select("chunk", "first", "last", "n_rows", "n_tokens", late.alias("in_second_run"), again.cast("bigint").alias("n_rewritten"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "vocabulary_merge": q_vocabulary_merge,
    "encode_versions": q_encode_versions,
    "find_patterns": q_find_patterns,
    "bitmap_index": q_bitmap_index,
    "bitmap_semi_join": q_bitmap_semi_join,
    "bitmap_reconcile": q_bitmap_reconcile,
    "nested_values": q_nested_values,
    "chunks_once": q_chunks_once,
    "split_archive": q_split_archive,
}
