"""A vocabulary that grows: append-only ids over many inputs.

A store is a folder with one table per version.  Version k holds the counts of
one input's tokens, ``(token, n, id, is_new)``: ids of tokens that earlier
versions know are theirs, new tokens get the next free ids by count, then by
token.  An id never changes and is never given twice, so tables encoded with
an old version stay valid, and counts of versions add up.

A version is there once its line in the manifest is; the line is written
after the table.  A merge that was killed in between leaves a table that the
next merge of that number overwrites, and an input that the manifest names
already is not merged again, so a repeated merge changes nothing.  One
writer at a time.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.constants import MARKER, VOCAB_HEAD_ROWS
from tokenloom.functions.text import marker_tokens
from tokenloom.operators.lookup import Head, make_head, short_key
from tokenloom.operators.rowindex import ordered_index
from tokenloom.operators.vocab import encode, id_of_rank

_MANIFEST = "version int, source string, known bigint"


def token_counts(tokens_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(token, n)`` of an array column; combined in the map tasks first."""
    return (tokens_df.select(F.explode(tokens_col).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


class VocabularyStore:
    """Versions of one vocabulary under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- manifest ---------------------------------------------------------

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def manifest(self) -> list[tuple[int, str, int]]:
        """``(version, source, ids given so far)`` of every version, in order."""
        if not self._exists(f"{self.path}/manifest"):
            return []
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest/*").collect()
        return sorted((r["version"], r["source"], r["known"]) for r in rows)

    def table(self, version: int) -> DataFrame:
        """One version alone: ``(token, n, id, is_new)``."""
        return self.spark.read.parquet(f"{self.path}/version={version}")

    # --- writing ----------------------------------------------------------

    def merge(self, counts: DataFrame, source: str, extra_tokens: Sequence[str] = ()) -> int:
        """Add ``counts(token, n)`` of the input named ``source``; its version.
        ``extra_tokens`` are present even where no record holds them."""
        versions = self.manifest()
        for version, name, _ in versions:
            if name == source:
                return version
        version, known = len(versions), versions[-1][2] if versions else 0
        if extra_tokens:
            extra = self.spark.createDataFrame([(t, 0) for t in extra_tokens], "token string, n bigint")
            counts = counts.select("token", "n").unionByName(extra).groupBy("token").agg(F.sum("n").cast("bigint").alias("n"))
        out = f"{self.path}/version={version}"
        if not versions:
            self._ranked(counts, 0).write.mode("overwrite").parquet(out)
        else:
            ids = self.ids()
            old = counts.join(ids, "token").select("token", "n", "id", F.lit(False).alias("is_new"))
            new = self._ranked(counts.join(ids, "token", "left_anti"), known)
            old.unionByName(new).write.mode("overwrite").parquet(out)
        known += self.table(version).where("is_new").count()
        (self.spark.createDataFrame([(version, source, known)], _MANIFEST).coalesce(1)
         .write.mode("overwrite").json(f"{self.path}/manifest/{version:08d}"))
        return version

    @staticmethod
    def _ranked(counts: DataFrame, known: int) -> DataFrame:
        ranked = ordered_index(counts, [F.col("n").desc(), F.col("token").asc()], "rank")
        return ranked.select("token", "n", id_of_rank(F.col("rank") + F.lit(known)).alias("id"), F.lit(True).alias("is_new"))

    # --- reading ----------------------------------------------------------

    def _upto(self, version: int | None) -> list[DataFrame]:
        last = len(self.manifest()) - 1 if version is None else version
        if last < 0:
            raise ValueError(f"no vocabulary under {self.path}")
        return [self.table(k) for k in range(last + 1)]

    def ids(self, version: int | None = None) -> DataFrame:
        """``(token, id)`` up to a version: no aggregation, ids are given once."""
        parts = [t.where("is_new").select("token", "id") for t in self._upto(version)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def read(self, version: int | None = None) -> DataFrame:
        """``(token, n, id)`` with the counts of all versions added up."""
        parts = self._upto(version)
        if len(parts) == 1:
            return parts[0].select("token", "n", "id")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("token", "id").agg(F.sum("n").cast("bigint").alias("n")).select("token", "n", "id")

    def head(self, version: int | None = None, head_rows: int = VOCAB_HEAD_ROWS) -> Head:
        """What every encoding task holds: the first ``head_rows`` ids, and any
        later token that fills more than one in ``head_rows`` of all positions
        (there are fewer than ``head_rows`` of these), so that no token which
        is joined is hot."""
        vocab = self.read(version)
        total = vocab.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        table = vocab.select(short_key("token").alias("key"), F.col("id").cast("int").alias("value"), "n")
        return make_head(table, F.col("value").between(0, head_rows - 1) | (F.col("n") > total / head_rows))

    def encode(self, df: DataFrame, key_cols: Sequence[str], version: int | None = None, head: Head | None = None, **options) -> DataFrame:
        """``df`` with the ids of a version in the place of its tokens."""
        return encode(df, self.ids(version), key_cols, head=head or self.head(version), **options)


def open_vocabulary(spark: SparkSession, path: str, counts: DataFrame, source: str) -> VocabularyStore:
    """The store under ``path`` with ``source`` merged, the marker's tokens first
    of all; made if it is not there."""
    store = VocabularyStore(spark, path)
    store.merge(counts, source, tuple(marker_tokens(MARKER)) if not store.manifest() else ())
    return store
