"""Input rows as one struct, so that no column of theirs can clash with a
name that an operator uses inside."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, *more: Column, without: Sequence[str] = ()) -> DataFrame:
    """``(row, more...)``; ``without``: columns that ``more`` has already (texts,
    which should not travel twice)."""
    rest = [df[c] for c in df.columns if c not in without] or [F.lit(None).alias("nothing")]
    return df.select(F.struct(*rest).alias("row"), *more)


def row_type(df: DataFrame, without: Sequence[str] = ()) -> str:
    return f"row {packed(df, without=without).schema['row'].dataType.simpleString()}"


def unpacked(out: DataFrame, df: DataFrame, results: Sequence[str] = (), beside: dict[str, str] | None = None) -> DataFrame:
    """The columns of ``df``, then ``results``; a result takes the place of a
    column of its name.  ``beside``: columns of ``df`` that stand beside the
    row, and under which name."""
    beside = beside or {}
    keep = [c for c in df.columns if c not in results]
    return out.select(*[(F.col(beside[c]) if c in beside else F.col("row").getField(c)).alias(c) for c in keep], *results)
