"""Plan-shape regressions: what the optimizer must not undo."""

import re

from pyspark.sql import functions as F

from tokenloom.functions.text import marker_tokens
from tokenloom.operators.blocks import pack_blocks
from tokenloom.operators.marker import drop_flagged, flag_records, length_filter
from tokenloom.operators.vocab import with_tokens

SCHEMA = "split string, row_idx bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokenize_runs_once_under_filters(spark):
    df = spark.createDataFrame([(i, f"<DFF> text {i}") for i in range(10)], "doc_id bigint, text string")
    t = length_filter(with_tokens(df), 100, "tokens")
    t = drop_flagged(flag_records(t, marker_tokens(), 50))
    plan = _physical(t)
    assert plan.count("regexp_extract_all") == 1, plan


def test_pack_reuses_window_partitioning(spark):
    rows = [("train", i, [i, i + 1], [1, 1], [i, i + 1]) for i in range(50)]
    b = pack_blocks(spark.createDataFrame(rows, SCHEMA), 4, batch_rows=10)
    plan = _physical(b)
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert parts and not any("block_id" in p for p in parts), parts


def test_rows_are_counted_without_the_arrays(spark):
    df = spark.createDataFrame([("train", i, [i], [1], [i]) for i in range(50)], SCHEMA)
    encoded = df.mapInArrow(lambda batches: batches, SCHEMA)
    rows = df.select("split", "row_idx", F.size("input_ids").alias("n_tokens"))
    plan = _physical(pack_blocks(encoded, 4, batch_rows=10, rows=rows))
    assert plan.count("MapInArrow") == 1, plan


def test_pack_shuffles_the_arrays_once(spark):
    df = spark.createDataFrame([("train", i, [i], [1], [i]) for i in range(50)], SCHEMA)
    b = pack_blocks(df, 4, batch_rows=10)
    plan = _physical(b)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, plan
    assert b.count() == 25
    # one batch: the second exchange holds only pieces at part borders, the first is shared
    plan = _physical(pack_blocks(df, 4, batch_rows=None))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(split") - plan.count("ReusedExchange") <= 3, plan


def test_scan_prunes_columns(spark, tmp_dir):
    spark.range(20).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                           F.lit("y").alias("other")).write.parquet(f"{tmp_dir}/t")
    d = spark.read.parquet(f"{tmp_dir}/t").where(F.col("doc_id") < 5).select("doc_id", "text")
    plan = _physical(d)
    assert "other" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters: [IsNotNull(doc_id), LessThan(doc_id,5)]" in plan
