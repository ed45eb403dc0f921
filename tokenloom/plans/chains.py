"""Registered queries that join the parts: files to blocks, resumed tables,
late tokens, two passes over archives, caps and summaries.

Like ``plans/queries.py``; the twins are in ``plans/chain_oracle.py``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import marker_tokens
from tokenloom.constants import MARKER
from tokenloom.operators.checks import first_sample, missing_marker_counts, row_count, split_summary
from tokenloom.operators.marker import flag_records, length_filter
from tokenloom.operators.rowindex import cap_sorted, positional_split
from tokenloom.operators.user import filter_rows, map_batches
from tokenloom.operators.vocab import build_vocabulary, decode, encode, unknown_count, with_tokens
from tokenloom.plans import queries as q
from tokenloom.plans.flows import (BlockConfig, archive_to_token_table, global_index, prepare_training_blocks,
                                   two_pass_filter)
from tokenloom.plans.records import diff_records, documents, table
from tokenloom.session import land, scratch_path
from tokenloom.sinks.tables import backup, write_text_json, write_token_table
from tokenloom.sources.files import read_archive, read_named, read_split_files, read_table


def _cfg(**kw) -> BlockConfig:
    return BlockConfig(**{"block_size": q.PACK_BLOCK, "batch_rows": q.PACK_BATCH, "validation_percent": q.PERCENT,
                          "concatenate_texts": True, **kw})


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return diff_records(spark, sf).select(F.col("doc_id").alias("row_idx"), "text")


def _token_table(spark: SparkSession, sf: str):
    """Every record tokenized, saved as a token table and opened again."""
    t = land(with_tokens(_records(spark, sf)).drop("text"), "tokens")
    vocab = build_vocabulary(t.select("tokens"))
    path = scratch_path(spark, "token-table")
    write_token_table(encode(t, vocab, ["row_idx"], landed=True), path, keep=["row_idx"])
    return read_table(spark, path), vocab


def _row_out(b: DataFrame) -> DataFrame:
    return b.select("split", F.col("row_idx").alias("doc_id"), q.n_of("input_ids").alias("n_ids"),
                    q.h("input_ids").alias("ids_md5"), q.h("attention_mask").alias("mask_md5"), q.h("labels").alias("labels_md5"))


def q_archive_to_blocks(spark, sf):
    """E1 into E2: archives, token table, one index over all files, blocks."""
    table, _, vocab = archive_to_token_table(read_archive(spark, q._write_record_archives(spark, sf)), max_tokens=q.MAX_TOKENS)
    path = scratch_path(spark, "token-table")
    write_token_table(table, path, keep=["file", "row_idx"])
    return q._block_out(prepare_training_blocks(global_index(read_table(spark, path)), _cfg(), vocab)[0])


def q_resume_tokenized(spark, sf):
    """E2 from a saved token table without labels: the marker is found in the ids."""
    table, vocab = _token_table(spark, sf)
    return _row_out(prepare_training_blocks(table, _cfg(concatenate_texts=False), vocab)[0])


def q_force_label(spark, sf):
    """E2 from a token table whose labels are made anew."""
    table, vocab = _token_table(spark, sf)
    table = table.withColumn("labels", F.transform("input_ids", lambda x: F.lit(0)))
    return q._block_out(prepare_training_blocks(table, _cfg(force_label=True), vocab)[0])


def q_pad_training(spark, sf):
    return _row_out(prepare_training_blocks(_records(spark, sf), _cfg(concatenate_texts=False))[0])


def q_skip_concat(spark, sf):
    return _row_out(prepare_training_blocks(_records(spark, sf), _cfg(skip_concat=True))[0])


def q_split_train_only(spark, sf):
    """E2 from files of a train split only: a validation split is cut off."""
    path = scratch_path(spark, "train-only") + "/train.json"
    write_text_json(_records(spark, sf).orderBy("row_idx"), path)
    return q._block_out(prepare_training_blocks(read_split_files(spark, path, order_col="row_idx"), _cfg())[0])


def q_first_sample(spark, sf):
    blocks, vocab = prepare_training_blocks(_records(spark, sf), _cfg())
    s = first_sample(blocks, vocab=vocab)
    return s.select("batch_id", "block_id", F.col("seg_start").cast("bigint").alias("seg_start"),
                    F.col("seg_end").cast("bigint").alias("seg_end"),
                    F.md5("decoded").alias("decoded_md5"), F.md5("segment").alias("segment_md5"))


def q_cap_after_pack(spark, sf):
    """P7 over the packed blocks, not over the raw rows."""
    blocks, _ = prepare_training_blocks(_records(spark, sf), _cfg())
    return q._block_out(cap_sorted(blocks, q.CAP, ["batch_id", "block_id"]))


def q_marker_counts(spark, sf):
    t = q._records_tokens(spark, sf)
    f = flag_records(t, marker_tokens(MARKER), q.MAX_TOKENS).select("doc_id", (~F.col("without_dff")).alias("valid"))
    return missing_marker_counts(positional_split(f, "doc_id", q.PERCENT))


def q_split_summary(spark, sf):
    return split_summary(positional_split(documents(spark, sf).select("doc_id"), "doc_id", q.PERCENT))


def q_stream_new_tokens(spark, sf):
    """T1 with a vocabulary of the conversations: the archives' other tokens get
    ids from the stream's state, then all archives are encoded and decoded."""
    from tokenloom.streaming.chunks import stream_masked
    from tokenloom.streaming.new_tokens import stream_new_ids, with_new_ids
    arch = q._write_record_archives(spark, sf)
    vocab = land(build_vocabulary(with_tokens(table(spark, sf, "conversations").select("text")).select("tokens")), "vocabulary")
    new, out = scratch_path(spark, "new-ids"), scratch_path(spark, "stream-out")
    stream_new_ids(spark, arch, vocab, new, scratch_path(spark, "new-ids-ckpt"), max_files_per_trigger=5)
    whole = land(with_new_ids(vocab, new), "vocabulary")
    stream_masked(spark, arch, whole, out, scratch_path(spark, "stream-ckpt"), max_tokens=q.MAX_TOKENS, max_files_per_trigger=5)
    known = vocab.agg(F.max("id")).first()[0]
    rows = spark.read.parquet(out).select("file", "row_idx", "input_ids")
    rows = rows.withColumns({"n_ids": q.n_of("input_ids"), "n_new": q.n_of(F.filter("input_ids", lambda x: x > known)),
                             "n_unknown": unknown_count().cast("bigint")})
    dec = decode(rows, whole, ["file", "row_idx"], "input_ids", "decoded")
    n, n_ids = whole.agg(F.count(F.lit(1)), F.countDistinct("id")).first()
    return dec.select("file", "row_idx", "n_ids", "n_new", "n_unknown", F.md5("decoded").alias("decoded_md5"),
                      F.lit(n).cast("bigint").alias("n_vocabulary"), F.lit(n_ids).cast("bigint").alias("n_vocabulary_ids"))


def q_two_pass_filter(spark, sf):
    """E3 on archives: index of short records, kept rows written back, read again."""
    out = scratch_path(spark, "filtered")
    two_pass_filter(spark, q._write_record_archives(spark, sf), scratch_path(spark, "index"), out, q.LIMIT_N)
    return read_archive(spark, out).select("file", "row_idx", F.md5("text").alias("text_md5"))


def q_tfrecord_strict(spark, sf):
    """Every record below the limit, backed up, counted and exported."""
    from tokenloom.sinks.tfrecord import read_tfrecords, write_tfrecords
    arch = read_archive(spark, q._write_record_archives(spark, sf))
    t = land(with_tokens(arch).drop("text"), "tokens")
    vocab = build_vocabulary(t.select("tokens"))
    kept = length_filter(t, q.MAX_TOKENS, "tokens", inclusive=False)
    ids = backup(encode(kept, vocab, ["file", "row_idx"], with_mask=False, landed=True).select(F.col("input_ids").alias("ids")))
    path = scratch_path(spark, "tfrecord")
    write_tfrecords(ids, path)
    return read_tfrecords(spark, path).select(q.n_of("ids").alias("n_ids"), q.h("ids").alias("ids_md5"),
                                              F.lit(row_count(ids)).cast("bigint").alias("n_exported"))


def q_named_table(spark, sf):
    root = scratch_path(spark, "named")
    documents(spark, sf).select("doc_id", "text").write.parquet(f"{root}/documents/plain")
    return read_named(spark, "documents", "plain", root).select("doc_id", F.md5("text").alias("text_md5"))


def q_text_lines(spark, sf):
    """The lines of text files, with and without their line breaks."""
    path = scratch_path(spark, "lines") + "/train.txt"
    documents(spark, sf).select("text").write.text(path)
    parts = [read_split_files(spark, path, keep_linebreaks=k).select(F.lit(k).alias("keep_linebreaks"), F.length("text").alias("n"))
             for k in (True, False)]
    return parts[0].unionByName(parts[1]).groupBy("keep_linebreaks").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").cast("bigint").alias("n_chars"))


def q_user_functions(spark, sf):
    """A map over Arrow batches and a predicate on its result."""
    def lengths(batch):
        import pyarrow as pa
        import pyarrow.compute as pc
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.utf8_length(batch.column("text")).cast(pa.int64())],
                                          names=["doc_id", "n"])
    out = map_batches(documents(spark, sf).select("doc_id", "text"), lengths, "doc_id bigint, n bigint")
    return filter_rows(out, F.col("n") > q.LIMIT_N)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "archive_to_blocks": q_archive_to_blocks,
    "resume_tokenized": q_resume_tokenized,
    "force_label": q_force_label,
    "pad_training": q_pad_training,
    "skip_concat": q_skip_concat,
    "split_train_only": q_split_train_only,
    "first_sample": q_first_sample,
    "cap_after_pack": q_cap_after_pack,
    "marker_counts": q_marker_counts,
    "split_summary": q_split_summary,
    "stream_new_tokens": q_stream_new_tokens,
    "two_pass_filter": q_two_pass_filter,
    "tfrecord_strict": q_tfrecord_strict,
    "named_table": q_named_table,
    "text_lines": q_text_lines,
    "user_functions": q_user_functions,
}
