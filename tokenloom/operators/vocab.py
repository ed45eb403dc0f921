"""Vocabulary, encoding and decoding.

The vocabulary is a Spark job over the data: explode tokens, count per token
(map-side partial counts, so hot tokens are combined before the shuffle),
rank by count descending then token ascending.  Id 50256 is kept for EOS.

Encoding looks every token up inside its row (see :mod:`lookup`).  The head
is the ``VOCAB_HEAD_ROWS`` most frequent tokens, so a token of the tail fills
at most one in ``VOCAB_HEAD_ROWS`` positions and no key of its join is hot.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.constants import EOS_ID, MARKER, UNKNOWN_ID, VOCAB_HEAD_ROWS
from tokenloom.functions.arrays import attention_mask
from tokenloom.functions.text import marker_tokens, tokenize
from tokenloom.operators.lookup import SHORT_BYTES, Head, make_head, map_array, short_key
from tokenloom.operators.rowindex import ordered_index


def with_tokens(df: DataFrame, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """F1 applied to a table.

    The tokens are produced as the output of a one-element ``explode``, not
    as a projected expression.  Catalyst rewrites a filter pushed through a
    projection by inlining the projected expression; a length or marker
    filter on the tokens would then repeat the regex extraction, and inside
    the marker search's lambda once per array position.  A filter cannot be
    pushed below a generator's own output, so the extraction runs once.
    """
    return df.select("*", F.explode(F.array(tokenize(text_col))).alias(out_col))


def id_of_rank(rank) -> F.Column:
    """Ranks above the reserved id shift by one."""
    r = F.col(rank) if isinstance(rank, str) else rank
    return F.when(r < EOS_ID, r).otherwise(r + 1).cast("bigint")


def build_vocabulary(tokens_df: DataFrame, tokens_col: str = "tokens",
                     extra_tokens: Sequence[str] = tuple(marker_tokens(MARKER))) -> DataFrame:
    """``(token, n, id)``; ``n`` = occurrences; ``extra_tokens`` (the
    marker's) are present even when no record holds them (``n`` = 0).

    The ranked counts are landed in the shared checkpoint folder, so the ids
    are fixed once and cannot change on recomputation.
    """
    spark = tokens_df.sparkSession
    counts = (tokens_df.select(F.explode(tokens_col).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    if extra_tokens:
        extras = spark.createDataFrame([(t, 0) for t in extra_tokens], "token string, n bigint")
        counts = (counts.unionByName(extras)
                  .groupBy("token").agg(F.sum("n").cast("bigint").alias("n")))
    ranked = ordered_index(counts, [F.col("n").desc(), F.col("token").asc()], "rank")
    return ranked.select("token", "n", id_of_rank("rank").alias("id"))


def vocabulary_head(vocab: DataFrame, head_rows: int = VOCAB_HEAD_ROWS) -> Head:
    """The most frequent ``head_rows`` tokens (ids go by frequency), each as a
    key of bounded size, ready for :func:`encode`.  Make it once to encode
    many tables with the same vocabulary."""
    return make_head(_by_token(vocab), F.col("value").between(0, head_rows - 1))


def _by_token(vocab: DataFrame) -> DataFrame:
    return vocab.select(short_key("token").alias("key"), F.col("id").cast("int").alias("value"))


def encode(df: DataFrame, vocab: DataFrame, key_cols: Sequence[str], tokens_col: str = "tokens",
           out_col: str = "input_ids", with_mask: bool = True, head: Head | None = None, landed: bool = False) -> DataFrame:
    """Token strings -> ``input_ids`` (``array<int>``), plus F4's
    ``attention_mask``.  ``key_cols`` must identify a row.  The tokens column
    is replaced; a token missing from the vocabulary gets ``UNKNOWN_ID``
    (count them with :func:`unknown_count`).  ``landed``: see ``map_array``."""
    head = head or vocabulary_head(vocab)
    out = map_array(df, key_cols, tokens_col, out_col, _by_token(vocab), head, "string", "int", landed)
    out = out.withColumn(out_col, F.transform(out_col, lambda x: F.coalesce(x, F.lit(UNKNOWN_ID))))
    if with_mask:
        out = out.withColumn("attention_mask", attention_mask(out_col))
    return out


def unknown_count(ids_col: str = "input_ids") -> F.Column:
    """Tokens of a row that the vocabulary did not hold."""
    return F.size(F.filter(ids_col, lambda x: x == UNKNOWN_ID))


def decode(df: DataFrame, vocab: DataFrame, key_cols: Sequence[str], ids_col: str = "input_ids",
           out_col: str = "decoded", sep: str = " ", head_rows: int = VOCAB_HEAD_ROWS) -> DataFrame:
    """ids -> tokens joined by ``sep`` (EOS and unknown ids are left out)."""
    v = vocab.select(F.col("id").cast("int").alias("key"), F.col("token").alias("value"))
    head = make_head(v, F.col("key").between(0, head_rows - 1) & (F.octet_length("value") <= SHORT_BYTES))
    ids = df.withColumn(ids_col, F.filter(ids_col, lambda x: ~x.isin(EOS_ID, UNKNOWN_ID)))
    out = map_array(ids, key_cols, ids_col, "_tok", v, head, "int", "string")
    return out.withColumn(out_col, F.array_join("_tok", sep)).drop("_tok")


def pattern_ids(vocab: DataFrame, pattern_tokens: Sequence[str]) -> list[int]:
    """ids of a short literal's tokens (collects at most ``len`` rows)."""
    rows = vocab.where(F.col("token").isin(list(pattern_tokens))).select("token", "id").collect()
    lookup = {r["token"]: int(r["id"]) for r in rows}
    missing = [t for t in pattern_tokens if t not in lookup]
    if missing:
        raise ValueError(f"tokens {missing} are not in the vocabulary")
    return [lookup[t] for t in pattern_tokens]
