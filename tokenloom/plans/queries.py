"""Registered queries: one per operator group, each over the whole tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame.  Arrays are
returned as ``md5(array_join(x, ' '))`` plus their length so that results
compare as plain values.  The DuckDB twins live in ``plans/oracle.py``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.constants import IGNORE_LABEL, MARKER
from tokenloom.functions.arrays import find_all, first_unmasked_segment
from tokenloom.functions.text import marker_tokens
from tokenloom.operators.blocks import pack_blocks, pad_blocks
from tokenloom.operators.checks import block_report, quality_counts
from tokenloom.operators.indexing import files_to_process, index_to_text, keep_indexed, reconcile
from tokenloom.operators.marker import (flag_records, length_filter, truncate_columns, with_labels,
                                        with_marker_index)
from tokenloom.operators.metrics import cross_entropy, perplexity, shifted_accuracy, with_argmax
from tokenloom.operators.rowindex import (cap_rows, chunk_id, cut_at_wraparound, dense_index,
                                          positional_split)
from tokenloom.operators.vocab import build_vocabulary, decode, encode, with_tokens
from tokenloom.plans.flows import archive_to_token_table, index_filter_pass1
from tokenloom.plans.records import diff_records, documents, table
from tokenloom.session import land, scratch_path

# query parameters (the SQL twins use the same numbers)
LIMIT_N = 512            # length filters
TRUNC_N = 64             # truncation
MAX_TOKENS = 2048        # producer limit (inclusive)
PACK_MAX = 1024          # records kept for packing: fewer tokens than this
PACK_BLOCK = 512
PACK_BATCH = 100
SHORT_MAX = 2048
SHORT_BLOCK = 4096
SHORT_BATCH = 5
PAD_BLOCK = 512
LARGE_BLOCK = 4096
CHUNK = 100
MIN_BATCH = 3
CAP = 100
PERCENT = 5
FIND_PATTERN = [".", "<"]


def h(arr) -> Column:
    """md5 of the space-joined array."""
    c = F.col(arr) if isinstance(arr, str) else arr
    return F.md5(F.array_join(c.cast("array<string>"), " "))


def n_of(arr) -> Column:
    return F.size(arr).cast("bigint")


# --------------------------------------------------------------------------
# shared building blocks
# --------------------------------------------------------------------------

def _records_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return with_tokens(diff_records(spark, sf)).select("doc_id", "source", "tokens")


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    return build_vocabulary(_records_tokens(spark, sf).select("tokens"))


def _masked_all(spark: SparkSession, sf: str, vocab: DataFrame | None = None) -> DataFrame:
    """Every record: ``doc_id, n_tokens, dff_idx, input_ids, attention_mask, labels``."""
    t = with_marker_index(_records_tokens(spark, sf).withColumn("n_tokens", n_of("tokens")), marker_tokens(MARKER))
    t = land(t.select("doc_id", "n_tokens", "dff_idx", "tokens"), "tokens")
    vocab = vocab if vocab is not None else build_vocabulary(t.select("tokens"))
    enc = encode(t, vocab, ["doc_id"], landed=True)
    return with_labels(enc)


def _pack_input(spark: SparkSession, sf: str, max_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Trainer preprocessing before blocks: records with fewer than
    ``max_tokens`` tokens and a marker, encoded and masked, one split; and
    the same rows' ``(split, row_idx, n_tokens)`` from the landed tokens."""
    t = _records_tokens(spark, sf).withColumn("n_tokens", F.size("tokens"))
    t = land(with_marker_index(t, marker_tokens(MARKER)).drop("source"), "tokens")
    vocab = build_vocabulary(t.select("tokens"))
    t = t.where((F.col("n_tokens") < max_tokens) & F.col("dff_idx").isNotNull())
    t = t.select(F.lit("train").alias("split"), F.col("doc_id").alias("row_idx"), "n_tokens", "dff_idx", "tokens")
    return with_labels(encode(t.drop("n_tokens"), vocab, ["row_idx"], landed=True)).drop("dff_idx"), t.select("split", "row_idx", "n_tokens")


def _packed(spark: SparkSession, sf: str, max_tokens: int, block: int, batch: int | None) -> DataFrame:
    df, rows = _pack_input(spark, sf, max_tokens)
    return pack_blocks(df, block, batch, rows=rows)


def _block_out(b: DataFrame) -> DataFrame:
    return b.select("split", "batch_id", "block_id", n_of("input_ids").alias("n_tokens"),
                    h("input_ids").alias("ids_md5"), h("attention_mask").alias("mask_md5"),
                    h("labels").alias("labels_md5"))


def _docs_with_position(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` with ``source`` as the file and the position inside it."""
    d = documents(spark, sf).select("doc_id", F.col("source").alias("file"), "text")
    return dense_index(d, "doc_id", ["file"], "row_idx")


def _label_index(spark: SparkSession, sf: str, docs: DataFrame) -> DataFrame:
    """Index of the documents labelled quality 1, each entry listed twice."""
    lab = table(spark, sf, "labels").where(F.col("quality") == 1).select("doc_id")
    idx = docs.select("doc_id", "file", "row_idx").join(lab, "doc_id", "left_semi").select("file", "row_idx")
    return idx.unionAll(idx)


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------

def q_tokenize_counts(spark, sf):
    t = with_tokens(documents(spark, sf)).select("doc_id", "tokens")
    return t.select("doc_id", n_of("tokens").alias("n_tokens"), h("tokens").alias("tokens_md5"))


def q_vocabulary(spark, sf):
    return _vocab(spark, sf)


def q_encode_ids(spark, sf, vocab=None):
    t = land(_records_tokens(spark, sf), "tokens")
    vocab = vocab if vocab is not None else build_vocabulary(t.select("tokens"))
    enc = encode(t.select("doc_id", "tokens"), vocab, ["doc_id"], landed=True)
    return enc.select("doc_id", n_of("input_ids").alias("n_ids"), h("input_ids").alias("ids_md5"),
                      F.aggregate("attention_mask", F.lit(0).cast("bigint"),
                                  lambda a, x: a + x).alias("mask_sum"))


def q_decode_text(spark, sf):
    t = land(_records_tokens(spark, sf), "tokens")
    vocab = build_vocabulary(t.select("tokens"))
    enc = encode(t.select("doc_id", "tokens"), vocab, ["doc_id"], with_mask=False, landed=True)
    dec = decode(enc, vocab, ["doc_id"], "input_ids", "decoded")
    return dec.select("doc_id", F.md5("decoded").alias("decoded_md5"))


def q_length_filter_strict(spark, sf):
    t = length_filter(_records_tokens(spark, sf), LIMIT_N, "tokens", inclusive=False)
    return t.select("doc_id", n_of("tokens").alias("n_tokens"))


def q_length_filter_inclusive(spark, sf):
    t = length_filter(_records_tokens(spark, sf), LIMIT_N, "tokens", inclusive=True)
    return t.select("doc_id", n_of("tokens").alias("n_tokens"))


def q_truncate_ids(spark, sf):
    t = land(_records_tokens(spark, sf), "tokens")
    vocab = build_vocabulary(t.select("tokens"))
    enc = truncate_columns(encode(t.select("doc_id", "tokens"), vocab, ["doc_id"], landed=True), TRUNC_N)
    return enc.select("doc_id", n_of("input_ids").alias("n_ids"), h("input_ids").alias("ids_md5"),
                      n_of("attention_mask").alias("n_mask"))


def q_find_all(spark, sf):
    t = _records_tokens(spark, sf).withColumn("pos", find_all("tokens", FIND_PATTERN))
    return t.select("doc_id", n_of("pos").alias("n_found"), F.array_join("pos", ",").alias("positions"))


def q_find_first(spark, sf):
    t = with_marker_index(_records_tokens(spark, sf), marker_tokens(MARKER))
    return t.select("doc_id", F.col("dff_idx").cast("bigint").alias("dff_idx"))


def q_mask_labels(spark, sf, vocab=None):
    m = _masked_all(spark, sf, vocab)
    return m.select("doc_id", F.col("dff_idx").cast("bigint").alias("dff_idx"),
                    n_of("labels").alias("n_labels"),
                    n_of(F.filter("labels", lambda x: x == F.lit(IGNORE_LABEL))).alias("n_masked"),
                    h("labels").alias("labels_md5"))


def q_flag_records(spark, sf):
    f = flag_records(_records_tokens(spark, sf), marker_tokens(MARKER), MAX_TOKENS, inclusive=True)
    return f.select("doc_id", "n_tokens", "without_dff", "invalid")


def q_quality_counts(spark, sf):
    f = flag_records(_records_tokens(spark, sf), marker_tokens(MARKER), MAX_TOKENS, inclusive=True)
    return quality_counts(f)


def q_chunk_quality(spark, sf):
    f = flag_records(_records_tokens(spark, sf), marker_tokens(MARKER), MAX_TOKENS, inclusive=True)
    return quality_counts(f.withColumn("chunk", chunk_id("doc_id", CHUNK)), ["chunk"])


def q_wraparound_cut(spark, sf):
    rec = diff_records(spark, sf).select("doc_id", "text")
    n = rec.count()
    laps = (rec.withColumn("row_idx", F.col("doc_id"))
               .unionByName(rec.withColumn("row_idx", F.col("doc_id") + F.lit(n))))
    return cut_at_wraparound(laps, "row_idx", "text", CHUNK, MIN_BATCH).select("row_idx", "doc_id")


def q_pack_blocks(spark, sf):
    return _block_out(_packed(spark, sf, PACK_MAX, PACK_BLOCK, PACK_BATCH))


def q_pack_short_batch(spark, sf):
    return _block_out(_packed(spark, sf, SHORT_MAX, SHORT_BLOCK, SHORT_BATCH))


def q_pack_global(spark, sf):
    """B1 with one batch for the whole split: only the last block's remainder is lost."""
    return _block_out(_packed(spark, sf, PACK_MAX, PACK_BLOCK, None))


def q_pad_left(spark, sf):
    p = pad_blocks(_pack_input(spark, sf, PAD_BLOCK)[0], PAD_BLOCK)
    return p.select(F.col("row_idx").alias("doc_id"), n_of("input_ids").alias("n_ids"),
                    h("input_ids").alias("ids_md5"), h("attention_mask").alias("mask_md5"),
                    h("labels").alias("labels_md5"))


def q_training_blocks(spark, sf):
    """E2 end to end: positional split, length filter, marker, labels, pack."""
    from tokenloom.plans.flows import BlockConfig, prepare_training_blocks
    rec = diff_records(spark, sf).select(F.col("doc_id").alias("row_idx"), "text")
    cfg = BlockConfig(block_size=PACK_BLOCK, batch_rows=PACK_BATCH, validation_percent=PERCENT,
                      concatenate_texts=True)
    blocks, _ = prepare_training_blocks(rec, cfg)
    return _block_out(blocks)


def q_block_size_large(spark, sf):
    """E2 with blocks longer than most records: none is lost to a length cap."""
    from tokenloom.plans.flows import BlockConfig, prepare_training_blocks
    rec = diff_records(spark, sf).select(F.col("doc_id").alias("row_idx"), "text")
    blocks, _ = prepare_training_blocks(rec, BlockConfig(block_size=LARGE_BLOCK, batch_rows=PACK_BATCH, validation_percent=PERCENT,
                                                         concatenate_texts=True))
    return _block_out(blocks)


def q_block_checks(spark, sf):
    b = _packed(spark, sf, PACK_MAX, PACK_BLOCK, PACK_BATCH)
    return block_report(b, PACK_BLOCK)


def q_split_positional(spark, sf):
    d = documents(spark, sf).select("doc_id")
    return positional_split(d, "doc_id", PERCENT).select("doc_id", "split", "split_idx")


def q_sample_cap(spark, sf):
    d = positional_split(documents(spark, sf).select("doc_id"), "doc_id", PERCENT)
    return cap_rows(d, CAP).select("doc_id", "split")


def q_index_filter(spark, sf):
    return index_filter_pass1(_docs_with_position(spark, sf), LIMIT_N)


def q_index_semi_join(spark, sf):
    docs = _docs_with_position(spark, sf)
    return keep_indexed(docs, _label_index(spark, sf, docs)).select("file", "row_idx", "doc_id")


def q_reconcile_files(spark, sf):
    docs = _docs_with_position(spark, sf)
    idx = _label_index(spark, sf, docs)
    return reconcile(docs, keep_indexed(docs, idx), idx)


def q_resume_files(spark, sf):
    docs = documents(spark, sf).select("doc_id", F.col("source").alias("file"))
    lab = table(spark, sf, "labels")
    with_index = docs.join(lab.where(F.col("quality") == 1).select("doc_id"), "doc_id", "left_semi")
    done = docs.join(lab.where(F.col("toxic") == 1).select("doc_id"), "doc_id", "left_semi")
    return files_to_process(docs, with_index, done)


def q_index_text(spark, sf):
    return index_to_text(index_filter_pass1(_docs_with_position(spark, sf), LIMIT_N))


def q_index_text_roundtrip(spark, sf):
    from tokenloom.sinks.tables import write_index_text
    from tokenloom.sources.files import read_index_text
    path = scratch_path(spark, "index-text")
    write_index_text(index_filter_pass1(_docs_with_position(spark, sf), LIMIT_N), path)
    return read_index_text(spark, path).select("file", "row_idx")


def q_argmax_embedding(spark, sf):
    e = with_argmax(table(spark, sf, "embeddings"), "embedding", "argmax")
    return e.select("vec_id", "argmax")


def q_shifted_accuracy(spark, sf):
    m = _masked_all(spark, sf).select(F.col("input_ids").alias("preds"), "labels")
    a = shifted_accuracy(m, "preds", "labels")
    return a.select("n_positions", "n_correct", F.round("accuracy", 9).alias("accuracy"))


def q_perplexity(spark, sf):
    e = table(spark, sf, "embeddings").select(
        cross_entropy("embedding", "label").cast("double").alias("loss"))
    p = perplexity(e, "loss")
    return p.select(F.col("n_loss").cast("bigint").alias("n_loss"),
                    F.round("mean_loss", 9).alias("mean_loss"), F.round("perplexity", 6).alias("perplexity"))


def q_first_unmasked(spark, sf):
    m = _masked_all(spark, sf)
    s, e = first_unmasked_segment("labels")
    return m.select("doc_id", s.cast("bigint").alias("seg_start"), e.cast("bigint").alias("seg_end"))


# --- sources and sinks ---------------------------------------------------------

def _write_record_archives(spark: SparkSession, sf: str) -> str:
    """diff records written as one archive per source, in doc_id order."""
    from tokenloom.sinks.archive import write_archive
    path = scratch_path(spark, "archive")
    rec = diff_records(spark, sf).withColumn("file", F.concat("source", F.lit(".jsonl.zst")))
    write_archive(rec, path, file_col="file", order_col="doc_id")
    return path


def q_archive_roundtrip(spark, sf):
    from tokenloom.sources.files import read_archive
    path = _write_record_archives(spark, sf)
    back = read_archive(spark, path)
    return back.select("file", "row_idx", F.md5("text").alias("text_md5"))


def q_count_files(spark, sf):
    from tokenloom.sources.files import count_files
    path = _write_record_archives(spark, sf)
    n = count_files(spark, path, "*jsonl.zst")
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n_files"))


def q_producer_tokens(spark, sf):
    from tokenloom.sources.files import read_archive
    path = _write_record_archives(spark, sf)
    out, _, _ = archive_to_token_table(read_archive(spark, path), max_tokens=MAX_TOKENS)
    return out.select("file", "row_idx", n_of("input_ids").alias("n_ids"),
                      h("input_ids").alias("ids_md5"), h("labels").alias("labels_md5"))


def q_tfrecord_export(spark, sf):
    from tokenloom.sinks.tfrecord import read_tfrecords, write_tfrecords
    from tokenloom.sources.files import read_archive
    arch = _write_record_archives(spark, sf)
    out, _, _ = archive_to_token_table(read_archive(spark, arch), max_tokens=MAX_TOKENS)
    path = scratch_path(spark, "tfrecord")
    write_tfrecords(out.select(F.col("input_ids").alias("ids")), path)
    back = read_tfrecords(spark, path)
    return back.select(n_of("ids").alias("n_ids"), h("ids").alias("ids_md5"))


def q_stream_masked(spark, sf):
    from tokenloom.streaming.chunks import stream_masked
    arch = _write_record_archives(spark, sf)
    vocab = _vocab(spark, sf)
    out = scratch_path(spark, "stream-out")
    stream_masked(spark, arch, vocab, out, scratch_path(spark, "stream-ckpt"),
                  max_tokens=MAX_TOKENS, max_files_per_trigger=5)
    back = spark.read.parquet(out)
    return back.select("file", "row_idx", n_of("input_ids").alias("n_ids"),
                       h("input_ids").alias("ids_md5"), h("labels").alias("labels_md5"))


def q_split_files(spark, sf):
    """JSON lines for train, CSV for validation, read back as one table."""
    from tokenloom.operators.marker import text_column
    from tokenloom.sinks.tables import write_text_json
    from tokenloom.sources.files import read_split_files
    base = scratch_path(spark, "split-files")
    write_text_json(documents(spark, sf), f"{base}/train.json")
    (table(spark, sf, "conversations").select("conv_id", "text")
        .write.option("header", True).csv(f"{base}/validation.csv"))
    df = read_split_files(spark, f"{base}/train.json", f"{base}/validation.csv")
    txt = text_column(df)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum(F.length(txt)).cast("bigint").alias("n_chars"))


def q_final_table(spark, sf):
    """K2: the final block table is written once; a second write with
    different content is ignored (``mode("ignore")``)."""
    from tokenloom.sinks.tables import write_final
    blocks = _packed(spark, sf, PACK_MAX, PACK_BLOCK, PACK_BATCH)
    path = scratch_path(spark, "final")
    write_final(blocks, path)
    write_final(blocks.limit(0), path)          # already there: kept as it is
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_blocks"),
                                     F.sum(F.size("input_ids")).cast("bigint").alias("n_tokens"))


def q_chunk_files(spark, sf):
    """K1 + K3: the producer's token table in numbered chunks of ``CHUNK``
    records (token columns only); rewriting a chunk replaces it."""
    from tokenloom.sinks.tables import write_chunks
    f = land(flag_records(_records_tokens(spark, sf), marker_tokens(MARKER), MAX_TOKENS, inclusive=True), "tokens")
    vocab = build_vocabulary(f.select("tokens"))
    f = f.where(~F.col("invalid"))
    enc = with_labels(encode(f.select("doc_id", "dff_idx", "tokens"), vocab, ["doc_id"], landed=True), max_tokens=MAX_TOKENS)
    out = enc.select(chunk_id("doc_id", CHUNK).alias("batch"), "input_ids", "attention_mask", "labels")
    path = scratch_path(spark, "chunks")
    write_chunks(out, path)
    write_chunks(out.where(F.col("batch") == 0), path)   # rerun of chunk 0 replaces it
    back = spark.read.parquet(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(F.size("input_ids")).cast("bigint").alias("n_tokens"),
                                     F.sum(F.size(F.filter("labels", lambda x: x != F.lit(IGNORE_LABEL))))
                                      .cast("bigint").alias("n_unmasked"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokenize_counts": q_tokenize_counts,
    "vocabulary": q_vocabulary,
    "encode_ids": q_encode_ids,
    "decode_text": q_decode_text,
    "length_filter_strict": q_length_filter_strict,
    "length_filter_inclusive": q_length_filter_inclusive,
    "truncate_ids": q_truncate_ids,
    "find_all": q_find_all,
    "find_first": q_find_first,
    "mask_labels": q_mask_labels,
    "flag_records": q_flag_records,
    "quality_counts": q_quality_counts,
    "chunk_quality": q_chunk_quality,
    "wraparound_cut": q_wraparound_cut,
    "pack_blocks": q_pack_blocks,
    "pack_short_batch": q_pack_short_batch,
    "pack_global": q_pack_global,
    "pad_left": q_pad_left,
    "block_checks": q_block_checks,
    "training_blocks": q_training_blocks,
    "block_size_large": q_block_size_large,
    "split_positional": q_split_positional,
    "sample_cap": q_sample_cap,
    "index_filter": q_index_filter,
    "index_semi_join": q_index_semi_join,
    "reconcile_files": q_reconcile_files,
    "resume_files": q_resume_files,
    "index_text": q_index_text,
    "index_text_roundtrip": q_index_text_roundtrip,
    "argmax_embedding": q_argmax_embedding,
    "shifted_accuracy": q_shifted_accuracy,
    "perplexity": q_perplexity,
    "first_unmasked": q_first_unmasked,
    "archive_roundtrip": q_archive_roundtrip,
    "count_files": q_count_files,
    "producer_tokens": q_producer_tokens,
    "tfrecord_export": q_tfrecord_export,
    "stream_masked": q_stream_masked,
    "split_files": q_split_files,
    "final_table": q_final_table,
    "chunk_files": q_chunk_files,
}
