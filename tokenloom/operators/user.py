"""User functions.

The built-in operators need no Python; these two entry points are for user
code, e.g. a real tokenizer loaded once per Python worker.  Both move data
in Arrow batches, never row by row.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` over every
    batch (``mapInArrow``); the row count may change, as in a batched map.
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` caps the batch size."""
    def run(batches: Iterator):
        for b in batches:
            out = fn(b)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, predicate: Column | Callable, *cols: str) -> DataFrame:
    """Keep rows where ``predicate`` holds.  A Column stays native; a
    Python callable gets pandas Series of ``cols`` and returns booleans
    (vectorised pandas UDF)."""
    if isinstance(predicate, Column):
        return df.where(predicate)
    if not cols:
        raise ValueError("name the columns the predicate reads")
    names = list(cols)

    @F.pandas_udf("boolean")
    def keep(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(predicate(*[frame[c] for c in names])).astype(bool)

    flag = "_keep"
    # evaluated once: the flag is computed, then filtered on
    return df.withColumn(flag, keep.asNondeterministic()(F.struct(*names))) \
             .where(F.col(flag)).drop(flag)
