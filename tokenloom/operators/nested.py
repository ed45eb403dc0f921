"""nested lists of any depth, flattened in order.

A JSON text becomes a VARIANT; each turn opens the lists of one level with
``variant_explode`` and ends when none is left, so the depth need not be known
and no Python runs.  An element's place is the path of its positions, arrays
of which sort in reading order.

What is kept follows an element type: ``INTS`` keeps whole numbers (booleans
count as such), ``INTS_AND_STRINGS`` strings as well.  Everything else, nulls,
fractions and objects with all they hold, is dropped.  A text that is itself
such an element gives it; a null, empty or broken text gives nothing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import land

INTS = ("BIGINT", "BOOLEAN")
INTS_AND_STRINGS = (*INTS, "STRING")


def nested_elements(df: DataFrame, key_cols: Sequence[str], text_col: str, keep: Sequence[str] = INTS) -> DataFrame:
    """``(key..., path, kind, value)``: the elements of the lists in ``text_col``;
    ``value`` as text."""
    spark, keys = df.sparkSession, list(key_cols)
    now = df.select(*keys, F.array().cast("array<int>").alias("path"), F.try_parse_json(F.col(text_col)).alias("v"))
    found = None
    while True:
        now = land(now.withColumn("kind", F.schema_of_variant("v")), "nested")
        here = now.where(F.col("kind").isin(list(keep))).select(*keys, "path", "kind", F.variant_get("v", "$", "string").alias("value"))
        found = here if found is None else found.unionByName(here)
        lists = now.where(F.col("kind").startswith("ARRAY"))
        if lists.isEmpty():
            return found
        opened = lists.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        now = opened.select(*keys, F.concat("path", F.array("pos")).alias("path"), F.col("value").alias("v"))


def flatten_nested(df: DataFrame, key_cols: Sequence[str], text_col: str, keep: Sequence[str] = INTS, out_col: str = "elements") -> DataFrame:
    """``(key..., elements)``: one array of the elements' texts in reading order
    for each row of ``df`` (``key_cols`` identify it); empty where there are none."""
    keys = list(key_cols)
    lists = nested_elements(df, keys, text_col, keep).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("path", "value"))).alias("_e"))
    out = df.select(*keys).join(lists, keys, "left")
    return out.select(*keys, F.coalesce(F.col("_e.value"), F.array().cast("array<string>")).alias(out_col))
