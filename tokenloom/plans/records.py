"""Input tables used by the registered queries.

``documents`` holds no marker, so diff records are derived from it in the
layout ``<NME> name / <BEF> before / <MSG> message / <DFF> after``; every
tenth record (``doc_id % 10 = 7``) has no ``<DFF>`` part.  This is a data
shape, not a row filter: every document becomes exactly one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` spread over the cores when the file has few splits."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def diff_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source, text)``, one diff record per document."""
    d = documents(spark, sf_dir)
    half = (F.col("n_chars") / 2).cast("int")   # n_chars div 2
    with_marker = F.concat(
        F.lit("<NME> "), F.col("source"), F.lit("\n"),
        F.lit("<BEF> "), F.substring(F.col("text"), F.lit(1), half), F.lit("\n"),
        F.lit("<MSG> "), F.col("lang"), F.lit("\n"),
        F.lit("<DFF> "), F.expr("substr(text, cast(n_chars div 2 as int) + 1)"))
    without = F.concat(F.lit("<NME> "), F.col("source"), F.lit("\n"), F.lit("<BEF> "), F.col("text"))
    return d.select("doc_id", "source",
                    F.when(F.col("doc_id") % 10 == 7, without).otherwise(with_marker).alias("text"))


# DuckDB twin of ``diff_records`` (FIXTURES.md section 3)
DIFF_RECORDS_SQL = """
SELECT doc_id, source,
       CASE WHEN doc_id % 10 = 7
            THEN '<NME> ' || source || chr(10) || '<BEF> ' || text
            ELSE '<NME> ' || source || chr(10)
              || '<BEF> ' || substr(text, 1, n_chars // 2) || chr(10)
              || '<MSG> ' || lang || chr(10)
              || '<DFF> ' || substr(text, n_chars // 2 + 1)
       END AS text
FROM documents
"""
