"""Checks and small sinks: A2, A4, A5, C2, C3, C6, K1, K7."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tokenloom.operators.blocks import pack_blocks
from tokenloom.operators.checks import (check_blocks, first_sample, land_checked, missing_marker_counts, require_columns,
                                        require_only_token_columns, row_count, split_summary)
from tokenloom.sinks.tables import backup, write_token_table

SCHEMA = "split string, row_idx bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"


def test_checks(spark, tmp_dir):
    rows = [("train", i, [i] * 5, [1] * 5, [-100, -100] + [i] * 3) for i in range(8)] + \
           [("validation", 0, [7] * 5, [1] * 5, [-100] * 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = pack_blocks(df, 4, batch_rows=3, keep_short=False)
    rep = check_blocks(blocks, 4)
    assert rep["train"]["wrong_size"] == 0 and rep["train"]["n_blocks"] > 0
    with pytest.raises(ValueError):
        check_blocks(pack_blocks(df, 4, batch_rows=1000, keep_short=True).where("split = 'validation'"), 4)
    s = first_sample(blocks).first()
    assert s["batch_id"] == 0 and s["block_id"] == 0 and s["seg_start"] == 2
    assert {r["split"]: r["n_rows"] for r in split_summary(df).collect()} == {"train": 8, "validation": 1}
    flags = df.withColumn("valid", F.col("row_idx") % 2 == 0)
    assert {r["split"]: r["without_dff"] for r in missing_marker_counts(flags).collect()} == \
        {"train": 4, "validation": 0}
    assert row_count(df) == 9
    require_columns(df, ["input_ids"])
    with pytest.raises(ValueError):
        require_columns(df, ["nope"])
    require_only_token_columns(df.drop("split", "row_idx"))
    with pytest.raises(ValueError):
        require_only_token_columns(df)
    write_token_table(df.withColumn("invalid", F.lit(False)), f"{tmp_dir}/k1", keep=["split"])
    assert spark.read.parquet(f"{tmp_dir}/k1").columns == ["split", "input_ids", "attention_mask", "labels"]
    assert backup(df).count() == 9


def test_landed_long_blocks_are_read_a_few_at_a_time(spark):
    size = 1 << 17
    arrays = [F.array_repeat(F.lit(v), size).alias(c) for c, v in (("input_ids", 7), ("attention_mask", 1), ("labels", 7))]
    blocks = spark.range(20).coalesce(1).select(F.lit("train").alias("split"), F.lit(0).alias("batch_id"), F.col("id").alias("block_id"), *arrays)
    landed = land_checked(blocks, size)
    groups = [m.row_group(i).num_rows for f in landed.inputFiles() for m in [pq.read_metadata(f.removeprefix("file://"))] for i in range(m.num_row_groups)]
    assert sum(groups) == 20 and max(groups) * size <= 1 << 19, groups      # a scan's batch ends with its row group
    assert landed.where(F.size("input_ids") == size).count() == 20
