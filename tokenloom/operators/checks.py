"""Data checks and counters.

Every counter is one aggregate in one job returning one small row; schema
checks run on the driver before any job starts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tokenloom.constants import IGNORE_LABEL
from tokenloom.functions.arrays import first_unmasked_segment
from tokenloom.operators.vocab import decode
from tokenloom.session import land


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def _quality() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("total"),
            _count_if(F.col("without_dff")).alias("without_dff"),
            _count_if(F.col("invalid")).alias("invalid")]


def quality_counts(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """A1: ``total``, ``without_dff`` and ``invalid`` counts (per group)."""
    return df.groupBy(*group_cols).agg(*_quality()) if group_cols else df.agg(*_quality())


def land_counted(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """A1 out of the job that writes: ``df`` landed, and its ``quality_counts``,
    observed on the way to the files."""
    seen = Observation("quality")
    landed = land(df.observe(seen, *_quality()), name)
    row = seen.get
    return landed, df.sparkSession.createDataFrame([tuple(int(row[c] or 0) for c in ("total", "without_dff", "invalid"))],
                                                   "total bigint, without_dff bigint, invalid bigint")


def missing_marker_counts(df: DataFrame, split_col: str = "split", valid_col: str = "valid") -> DataFrame:
    """A2: per split, rows whose ``valid`` flag is false."""
    return df.groupBy(split_col).agg(_count_if(~F.col(valid_col)).alias("without_dff"))


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A4: rows per split (the column list is ``df.columns``)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def row_count(df: DataFrame) -> int:
    """A5: number of kept sequences."""
    return df.count()


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """C3 (columns part): raise before any job when a column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_only_token_columns(df: DataFrame, extra: Sequence[str] = ()) -> None:
    """Nothing but the token columns (and ``extra`` keys) may remain."""
    allowed = {"input_ids", "attention_mask", "labels", *extra}
    bad = [c for c in df.columns if c not in allowed]
    if bad:
        raise ValueError(f"unexpected columns before blocks: {bad}")


def _block_checks(columns: Sequence[str], block_size: int | None, short_ok: bool) -> list[F.Column]:
    n_ids = F.size("input_ids")
    mism = (n_ids != F.size("attention_mask"))
    if "labels" in columns:
        mism = mism | (n_ids != F.size("labels"))
        first_masked = _count_if(F.get(F.col("labels"), 0) == F.lit(IGNORE_LABEL))
    else:
        first_masked = F.lit(None).cast("bigint")
    wrong = F.lit(False) if block_size is None else n_ids != F.lit(block_size)
    if short_ok:
        wrong = wrong & ~((n_ids < F.lit(block_size)) & (F.col("block_id") == 0))
    return [F.count(F.lit(1)).alias("n_blocks"), _count_if(mism).alias("len_mismatch"), _count_if(wrong).alias("wrong_size"),
            first_masked.alias("first_label_masked")]


def block_report(blocks: DataFrame, block_size: int | None, split_col: str = "split",
                 short_ok: bool = False) -> DataFrame:
    """C1, C4, C5 per split in one aggregate.

    ``len_mismatch``: rows whose ids, mask and labels lengths differ (C1);
    ``wrong_size``: rows not exactly ``block_size`` long (C4, over all rows,
    not only the first; with ``short_ok`` the only block of a short batch may
    be shorter; without a size it is 0); ``first_label_masked``: rows whose
    first label is -100 (C5 is a property of the first sample only, so it is
    counted).
    """
    return blocks.groupBy(split_col).agg(*_block_checks(blocks.columns, block_size, short_ok))


def land_checked(blocks: DataFrame, block_size: int | None, name: str = "blocks", split_col: str = "split", short_ok: bool = False,
                 labels: bool = True) -> DataFrame:
    """C1, C3 and C4 out of the job that writes: ``blocks`` landed, every row
    checked on its way to the files; blocks that break a check raise.  Reading
    them holds a bounded number of elements, however long a block is."""
    require_columns(blocks, [split_col, "input_ids", "attention_mask", *(["labels"] if labels else [])])
    seen = Observation("blocks")
    checks = [c for c in _block_checks([c for c in blocks.columns if labels or c != "labels"], block_size, short_ok)][:3]
    landed = land(blocks.observe(seen, *checks, _count_if(F.col(split_col) == "train").alias("train")), name, block_size)
    row = seen.get
    if not row["train"]:
        raise ValueError("no train split")
    if row["len_mismatch"]:
        raise ValueError(f"{row['len_mismatch']} rows with unequal column lengths")
    if row["wrong_size"]:
        raise ValueError(f"{row['wrong_size']} rows not of block size {block_size}")
    return landed


def check_blocks(blocks: DataFrame, block_size: int | None, split_col: str = "split",
                 require_train: bool = True, short_ok: bool = False, labels: bool = True) -> dict:
    """C3 + C1/C4 as hard errors; returns the report rows as a dict."""
    require_columns(blocks, [split_col, "input_ids", "attention_mask", *(["labels"] if labels else [])])
    rows = {r[split_col]: r.asDict() for r in block_report(blocks, block_size, split_col, short_ok).collect()}
    if require_train and "train" not in rows:
        raise ValueError("no train split")
    for split, r in rows.items():
        if r["len_mismatch"]:
            raise ValueError(f"{split}: {r['len_mismatch']} rows with unequal column lengths")
        if r["wrong_size"]:
            raise ValueError(f"{split}: {r['wrong_size']} rows not of block size {block_size}")
    return rows


def first_sample(blocks: DataFrame, split_col: str = "split", split: str = "train",
                 order: Sequence[str] = ("batch_id", "block_id"), vocab: DataFrame | None = None) -> DataFrame:
    """The first block of a split with its first unmasked segment, both
    decoded (``decoded``, ``segment``) if a vocabulary is given."""
    start, end = first_unmasked_segment("labels")
    one = (blocks.where(F.col(split_col) == split).orderBy(*order).limit(1)
                 .withColumn("seg_start", start).withColumn("seg_end", end))
    if vocab is None:
        return one
    seg = F.slice("labels", F.col("seg_start") + 1, F.col("seg_end") - F.col("seg_start"))
    both = one.withColumn("_seg", seg).withColumn("_ids", F.col("input_ids"))
    for ids, out in (("_ids", "decoded"), ("_seg", "segment")):
        both = decode(both, vocab, [split_col, *order], ids, out)
    return both
