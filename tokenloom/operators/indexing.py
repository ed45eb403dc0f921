"""Two-pass index filtering by ``(file, row_idx)`` (P2 -> K8, S7 -> J1-J3, A3).

Pass 1 keeps the positions of short records as an index table; pass 2 keeps
the rows of a data set whose position is listed.  The index is a table of
``(file, row_idx)``; the nested-list text form is an import/export format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.constants import DEFAULT_MAX_TOKENS, INDEX_TEXT_CHUNK
from tokenloom.functions.text import integers_in_text, list_literal_text


def short_record_index(df: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS,
                       tokens_col: str = "tokens") -> DataFrame:
    """Pass 1 (P2): ``(file, row_idx)`` of records with fewer than
    ``max_tokens`` tokens.  Every record is indexed."""
    return df.where(F.size(tokens_col) < max_tokens).select("file", "row_idx")


def keep_indexed(df: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose ``(file, row_idx)`` is listed; duplicates in the index
    do not duplicate rows (left semi join).  Files without an index entry
    keep nothing (J2 follows from the same join)."""
    return df.join(index.select("file", "row_idx"), ["file", "row_idx"], "left_semi")


def files_to_process(data_files: DataFrame, index_files: DataFrame, done_files: DataFrame) -> DataFrame:
    """J2 + J3: data files that have an index file and no output yet.
    Each argument is a one-column table ``file``."""
    return (data_files.select("file").distinct()
            .join(index_files.select("file"), "file", "left_semi")
            .join(done_files.select("file"), "file", "left_anti"))


def index_to_text(index: DataFrame, chunk_rows: int = INDEX_TEXT_CHUNK) -> DataFrame:
    """K8 text form: ``(file, chunk, index_text)`` with ``index_text`` like
    ``[0, 2, 5]``, sorted, at most ``chunk_rows`` indexes per line, so no
    group grows with the size of a file."""
    chunked = index.select("file", "row_idx",
                           F.floor(F.col("row_idx") / F.lit(chunk_rows)).cast("bigint").alias("chunk"))
    return (chunked.groupBy("file", "chunk")
            .agg(F.array_sort(F.collect_list("row_idx")).alias("_ids"))
            .select("file", "chunk", list_literal_text("_ids").alias("index_text")))


def index_from_text(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """S7 + F12: every integer of every line, with the line's ``file``."""
    return lines.select("file", F.explode(integers_in_text(text_col)).alias("row_idx"))


def reconcile(inputs: DataFrame, outputs: DataFrame, index: DataFrame) -> DataFrame:
    """A3: per file the input rows, output rows, distinct index entries and
    whether output rows equal distinct index entries that exist in the
    input.  Three small per-file counts and a full outer join."""
    ins = inputs.groupBy("file").agg(F.count(F.lit(1)).alias("in_rows"))
    outs = outputs.groupBy("file").agg(F.count(F.lit(1)).alias("out_rows"))
    idx = index.groupBy("file").agg(F.countDistinct("row_idx").alias("index_rows"))
    hit = (index.select("file", "row_idx").distinct().join(inputs.select("file", "row_idx"), ["file", "row_idx"], "left_semi")
           .groupBy("file").agg(F.count(F.lit(1)).alias("hit_rows")))
    j = ins.join(outs, "file", "full_outer").join(idx, "file", "full_outer").join(hit, "file", "left")
    zero = F.lit(0).cast("bigint")
    j = j.select("file", *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c)
                           for c in ("in_rows", "out_rows", "index_rows", "hit_rows")])
    return j.withColumn("ok", F.col("out_rows") == F.col("hit_rows")).drop("hit_rows")
