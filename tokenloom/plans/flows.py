"""The three end-to-end flows, each one logical plan over the operators.

E1 ``archive_to_token_table``: archive text -> flags, counters, masked
token table (the producer).
E2 ``prepare_training_blocks``: text or token table -> length filter ->
labels -> packed or padded blocks, with the data checks (the trainer's
preprocessing).
E3 ``index_filter_pass1`` / ``index_filter_pass2``: positions of short
records, then the rows at those positions, and the per-file reconciliation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.constants import (DEFAULT_BATCH_ROWS, DEFAULT_BUCKET_ROWS, DEFAULT_MAX_TOKENS,
                                 DEFAULT_VALIDATION_PERCENT, MARKER)
from tokenloom.functions.text import marker_tokens
from tokenloom.operators.blocks import TOKEN_COLS, block_mode, build_blocks
from tokenloom.operators.checks import land_checked, land_counted, require_columns, require_only_token_columns
from tokenloom.operators.indexing import files_to_process, keep_indexed, reconcile, short_record_index
from tokenloom.operators.marker import (drop_flagged, effective_block_size, flag_records, length_filter,
                                        text_column, with_labels, with_marker_index)
from tokenloom.operators.rowindex import ordered_index, positional_split, require_dense
from tokenloom.operators.vocab import build_vocabulary, encode, pattern_ids, with_tokens
from tokenloom.session import land
from tokenloom.sinks.archive import write_archive
from tokenloom.sinks.tables import write_index_text
from tokenloom.sources.files import list_archives, read_archive, read_index_text


# --------------------------------------------------------------------------
# E1
# --------------------------------------------------------------------------

def archive_to_token_table(records: DataFrame, key_cols=("file", "row_idx"),
                           max_tokens: int = DEFAULT_MAX_TOKENS, vocab: DataFrame | None = None,
                           marker: str = MARKER, keep_flags: bool = False):
    """``records`` holds ``key_cols`` + ``text``.  Returns
    ``(token_table, counters, vocab)``; ``counters`` is A1 over all records.

    Flags and lengths are decided on token strings; only kept records are
    encoded.  ``keep_flags`` keeps every record with its flags instead.  The
    records are read and tokenized once: the flagged tokens are landed, the
    counters are observed on the way, and the vocabulary and the encoding read
    that table.
    """
    keys = list(key_cols)
    t = with_tokens(records.select(*keys, "text")).drop("text")
    flagged, counters = land_counted(flag_records(t, marker_tokens(marker), max_tokens, inclusive=True), "tokens")
    if vocab is None:
        vocab = build_vocabulary(flagged.select("tokens"))
    kept = flagged if keep_flags else drop_flagged(flagged)
    kept = kept.select(*keys, "tokens", "dff_idx", *(["invalid", "without_dff"] if keep_flags else []))
    enc = encode(kept, vocab, keys, landed=True)
    out = with_labels(enc, max_tokens=max_tokens).drop("dff_idx")
    return out, counters, vocab


def global_index(table: DataFrame, out_col: str = "row_idx") -> DataFrame:
    """E1's table, keyed by ``(file, row_idx)``, with one dense 0-based index
    over all files in its place: the form that E2 takes."""
    t = ordered_index(table.withColumnRenamed("row_idx", "_in_file"), [F.col("file"), F.col("_in_file")], out_col)
    return t.drop("file", "_in_file")


# --------------------------------------------------------------------------
# E2
# --------------------------------------------------------------------------

@dataclass
class BlockConfig:
    block_size: int | None = None          # required
    max_length: int | None = None          # longest input of the model, if it has a limit
    ignore_long_samples: bool = True
    concatenate_texts: bool = False
    skip_concat: bool = False
    train_diff_model: bool = True
    force_label: bool = False
    batch_rows: int | None = DEFAULT_BATCH_ROWS
    validation_percent: float = DEFAULT_VALIDATION_PERCENT
    keep_short: bool = True
    check: bool = True                     # land the blocks and check them all
    bucket_rows: int = DEFAULT_BUCKET_ROWS
    marker: str = MARKER


def prepare_training_blocks(df: DataFrame, cfg: BlockConfig, vocab: DataFrame | None = None,
                            order_col: str = "row_idx"):
    """``df`` has a dense ``order_col`` and either text (column ``text``
    or the first column) or ``input_ids`` + ``attention_mask``.  Without a
    validation split the first ``validation_percent`` % become validation
    (P8), which needs an order column that is dense over the whole table
    (``global_index`` makes one of ``(file, row_idx)``).  Returns
    ``(blocks, vocab)``; blocks that break a check raise.
    """
    block = effective_block_size(cfg.block_size, cfg.max_length)
    mode = block_mode(cfg.ignore_long_samples, cfg.concatenate_texts, cfg.skip_concat)
    if "split" not in df.columns or df.where(F.col("split") == "validation").isEmpty():
        df = positional_split(df, order_col, cfg.validation_percent, require_dense(df, order_col)).drop("split_idx")
    keys = ["split", order_col]
    tokenized = "input_ids" in df.columns                         # P9
    if not tokenized:
        txt = text_column(df)
        t = with_tokens(df.select(*keys, F.col(txt).alias("text"))).drop("text")
        if cfg.train_diff_model:                                   # marker on token strings
            t = with_marker_index(t, marker_tokens(cfg.marker), "tokens")
        t = land(t.withColumn("n_tokens", F.size("tokens")), "tokens")      # tokenized once
        if vocab is None:                    # ids come from all records, not the kept ones
            vocab = build_vocabulary(t.select("tokens"))
        if cfg.ignore_long_samples:                                # P2 on token strings
            t = t.where(F.col("n_tokens") < block)
        if cfg.train_diff_model:
            t = t.where(F.col("dff_idx").isNotNull())
        rows = t.select(*keys, "n_tokens")
        t = encode(t.drop("n_tokens"), vocab, keys, landed=True)
    else:
        require_columns(df, ["attention_mask"])
        t = df
        if cfg.ignore_long_samples:                                # always before padding
            t = length_filter(t, block, "input_ids")
        rows = None
    if cfg.train_diff_model and (cfg.force_label or "labels" not in t.columns):
        if "dff_idx" not in t.columns:
            if vocab is None:
                raise ValueError("a vocabulary is needed to find the marker in token ids")
            t = with_marker_index(t, pattern_ids(vocab, marker_tokens(cfg.marker)), "input_ids")
            t = t.where(F.col("dff_idx").isNotNull())
        t = with_labels(t)
    t = t.drop("dff_idx")
    if tokenized:
        t = t.select(*keys, *[c for c in TOKEN_COLS if c in t.columns])
    require_only_token_columns(t, keys)                            # C2
    if mode == "concat":
        out = build_blocks(t, block, "concat", batch_rows=cfg.batch_rows, order_col=order_col,
                           keep_short=cfg.keep_short, bucket_rows=cfg.bucket_rows, rows=rows)
    else:
        out = build_blocks(t, block, mode)
    if cfg.check:                                                  # C1, C3, C4 over all blocks
        out = land_checked(out, None if mode == "skip" else block, short_ok=mode == "concat" and cfg.keep_short,
                           labels=cfg.train_diff_model)
    return out, vocab


# --------------------------------------------------------------------------
# E3
# --------------------------------------------------------------------------

def index_filter_pass1(records: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS) -> DataFrame:
    """E3 pass 1: ``(file, row_idx)`` of records with fewer than
    ``max_tokens`` tokens."""
    return short_record_index(with_tokens(records.select("file", "row_idx", "text")), max_tokens)


def index_filter_pass2(records: DataFrame, index: DataFrame):
    """E3 pass 2 + reconciliation: ``(kept rows, per-file report)``."""
    kept = keep_indexed(records, index)
    return kept, reconcile(records, kept, index)


def two_pass_filter(spark: SparkSession, archive_dir: str, index_dir: str, out_dir: str,
                    max_tokens: int = DEFAULT_MAX_TOKENS) -> DataFrame:
    """E3 on archives: index files of the short records (K8), then the rows
    at those positions written back as archives (K5).  Files that ``out_dir``
    has already are left out (J2, J3), so a second call goes on where the
    first one stopped.  Returns the per-file report of the files written."""
    records = land(read_archive(spark, archive_dir), "records")
    write_index_text(index_filter_pass1(records, max_tokens), index_dir)
    index = read_index_text(spark, index_dir)
    done = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in list_archives(spark, out_dir)], "file string")
    todo = files_to_process(records, index, done)
    kept, report = index_filter_pass2(records.join(todo, "file", "left_semi"), index.join(todo, "file", "left_semi"))
    report = land(report, "report")
    write_archive(kept, out_dir, file_col="file", order_col="row_idx")
    return report
