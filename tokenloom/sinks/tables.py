"""Table sinks (K1-K4, K7, K8)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.constants import INDEX_TEXT_CHUNK
from tokenloom.operators.indexing import index_to_text
from tokenloom.session import land

TOKEN_COLS = ("input_ids", "attention_mask", "labels")


def write_token_table(df: DataFrame, path: str, keep: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K1: only the token columns (plus ``keep``) are written; flag columns
    of the producer are left out."""
    cols = [c for c in (*keep, *TOKEN_COLS) if c in df.columns]
    df.select(*cols).write.mode(mode).parquet(path)


def write_final(df: DataFrame, path: str, split_col: str = "split") -> None:
    """K2: all splits in one table partitioned by split; an existing table is
    kept as it is (mode ``ignore``)."""
    df.write.mode("ignore").partitionBy(split_col).parquet(path)


def write_chunks(df: DataFrame, path: str, chunk_col: str = "batch") -> None:
    """K3: numbered chunks as ``{path}/{chunk_col}={n}/``; each chunk is
    replaced as a whole (dynamic partition overwrite), so a rerun is safe.
    A chunk's rows are brought together first, else every task would add a
    file to every chunk; a chunk too large for a task is shared by several."""
    (df.hint("rebalance", F.col(chunk_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(chunk_col).parquet(path))


def write_text_json(df: DataFrame, path: str, text_col: str = "text") -> None:
    """K4: JSON lines with only the text (a folder of part files)."""
    df.select(F.col(text_col).alias("text")).write.mode("overwrite").json(path)


def backup(df: DataFrame, name: str = "backup") -> DataFrame:
    """K7: land an intermediate table before an export and continue from it."""
    return land(df, name)


def write_index_text(index: DataFrame, path: str, chunk_rows: int = INDEX_TEXT_CHUNK) -> None:
    """K8: index text files, ``{path}/file=<data file name>/part-*.txt``;
    each line is a sorted list literal of at most ``chunk_rows`` indexes."""
    lines = index_to_text(index, chunk_rows)
    (lines.repartition("file").sortWithinPartitions("file", "chunk")
          .select("file", F.col("index_text").alias("value"))
          .write.mode("overwrite").partitionBy("file").text(path))
