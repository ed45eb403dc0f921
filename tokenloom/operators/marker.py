"""Marker search, label masking, record flags (F7-F10 on tables, P2-P6, F5, F6).

The marker search and the length checks run on token strings, before any
id lookup: token strings and ids map one to one, so the first marker
position is the same in both, and only surviving records are then encoded.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.constants import DEFAULT_MAX_TOKENS
from tokenloom.functions.arrays import find_first, mask_before, truncate


# --------------------------------------------------------------------------
# P1 / P2 / P3 / P6 / F5 / F6
# --------------------------------------------------------------------------

def text_column(df: DataFrame) -> str:
    """``text`` if present, else the first column."""
    if not df.columns:
        raise ValueError("table has no columns")
    return "text" if "text" in df.columns else df.columns[0]


def length_filter(df: DataFrame, n: int, arr_col: str = "tokens", inclusive: bool = False) -> DataFrame:
    """P2 (``size < n``, default) or P3 (``size <= n``, ``inclusive``)."""
    size = F.size(arr_col)
    return df.where(size <= n if inclusive else size < n)


def truncate_columns(df: DataFrame, n: int,
                     cols: Sequence[str] = ("input_ids", "attention_mask", "labels")) -> DataFrame:
    """cut every present token column to its first ``n`` elements."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, truncate(c, n))
    return df


def effective_block_size(block_size: int | None, max_length: int | None = None) -> int:
    """the block size, checked.  A size is required; one above
    ``max_length`` (the longest input of the model, if it has a limit) is an
    error, never a silent cut."""
    if block_size is None or block_size < 1:
        raise ValueError(f"a block size of at least 1 is required, got {block_size}")
    if max_length is not None and block_size > max_length:
        raise ValueError(f"block size {block_size} exceeds the model's maximum of {max_length}")
    return block_size


# --------------------------------------------------------------------------
# P4 / P5 / F10
# --------------------------------------------------------------------------

def with_marker_index(df: DataFrame, pattern: Sequence, arr_col: str = "tokens",
                      out_col: str = "dff_idx") -> DataFrame:
    """F8 on a table: first marker position or NULL."""
    return df.withColumn(out_col, find_first(arr_col, list(pattern)))


def flag_records(df: DataFrame, pattern: Sequence, max_tokens: int = DEFAULT_MAX_TOKENS,
                 arr_col: str = "tokens", inclusive: bool = True) -> DataFrame:
    """Add ``n_tokens``, ``dff_idx``, ``without_dff`` (no marker) and
    ``invalid`` (no marker, or longer than ``max_tokens``; with
    ``inclusive=False`` already at ``max_tokens``).  Nothing is dropped."""
    out = with_marker_index(df.withColumn("n_tokens", F.size(arr_col).cast("bigint")), pattern, arr_col)
    too_long = F.col("n_tokens") > max_tokens if inclusive else F.col("n_tokens") >= max_tokens
    return (out.withColumn("without_dff", F.col("dff_idx").isNull())
               .withColumn("invalid", F.col("without_dff") | too_long))


def drop_flagged(df: DataFrame, flag_col: str = "invalid", drop_flags: bool = True) -> DataFrame:
    """P5 (+P6): keep unflagged rows; by default drop the flag columns."""
    out = df.where(~F.col(flag_col))
    if drop_flags:
        out = out.drop(*[c for c in ("invalid", "without_dff", "valid") if c in out.columns])
    return out


def with_labels(df: DataFrame, ids_col: str = "input_ids", idx_col: str = "dff_idx",
                max_tokens: int | None = None, out_col: str = "labels") -> DataFrame:
    """``labels`` = -100 before the marker, the ids from it on; no
    marker gives ``[-100]``.  ``max_tokens`` cuts the labels as the producer
    does (``ids[idx:max_tokens]``)."""
    ids = F.col(ids_col) if max_tokens is None else truncate(ids_col, max_tokens)
    return df.withColumn(out_col, mask_before(ids, F.col(idx_col)))
