"""The archive flow joined to the block flow, and what must not vanish."""

import pytest
from pyspark.sql import functions as F

from tokenloom.constants import UNKNOWN_ID
from tokenloom.operators.indexing import reconcile
from tokenloom.operators.marker import effective_block_size
from tokenloom.operators.vocab import build_vocabulary, encode, unknown_count
from tokenloom.plans.flows import (BlockConfig, archive_to_token_table, global_index, prepare_training_blocks,
                                   two_pass_filter)
from tokenloom.sinks.tfrecord import read_tfrecords, write_tfrecords
from tokenloom.operators.checks import first_sample
from tokenloom.sinks.archive import write_archive
from tokenloom.sources.files import read_archive, read_split_files, resolve_archive_files


def records(spark, n=60):
    rows = [(f"f{i % 3}", i // 3, f"<NME> n{i} <BEF> a b c <DFF> d e {i}") for i in range(n)]
    return spark.createDataFrame(rows, "file string, row_idx bigint, text string")


def test_no_length_cap(spark):
    text = "<DFF> " + " ".join(f"t{i}" for i in range(3000))
    df = spark.createDataFrame([(0, text), (1, "<DFF> x")], "row_idx bigint, text string")
    for concat in (True, False):
        cfg = BlockConfig(block_size=4096, validation_percent=0, concatenate_texts=concat)
        blocks, _ = prepare_training_blocks(df, cfg)
        assert blocks.agg(F.sum(F.size(F.filter("input_ids", lambda x: x != 50256)))).first()[0] > 3000
    with pytest.raises(ValueError):
        effective_block_size(4096, 2048)
    with pytest.raises(ValueError):
        effective_block_size(None)


def test_archive_to_blocks(spark):
    table, _, vocab = archive_to_token_table(records(spark))
    cfg = BlockConfig(block_size=32, validation_percent=10, concatenate_texts=False)
    with pytest.raises(ValueError, match="row_idx"):
        prepare_training_blocks(table, cfg, vocab)
    indexed = global_index(table)
    assert sorted(r.row_idx for r in indexed.collect()) == list(range(60))
    blocks, _ = prepare_training_blocks(indexed, cfg, vocab)
    assert {r["split"]: r["count"] for r in blocks.groupBy("split").count().collect()} == {"validation": 6, "train": 54}
    train_only = indexed.withColumn("split", F.lit("train"))
    blocks, _ = prepare_training_blocks(train_only, cfg, vocab)
    assert blocks.where("split = 'validation'").count() == 6


def test_unknown_tokens(spark):
    df = spark.createDataFrame([(0, ["a", "b"])], "k bigint, tokens array<string>")
    vocab = build_vocabulary(df, extra_tokens=())
    new = spark.createDataFrame([(0, ["a", "zz", "b"]), (1, [])], "k bigint, tokens array<string>")
    rows = {r.k: r for r in encode(new, vocab, ["k"]).withColumn("u", unknown_count()).collect()}
    assert rows[0].input_ids[1] == UNKNOWN_ID and rows[0].u == 1 and None not in rows[0].input_ids and rows[1].u == 0


def test_reconcile_counts_existing_positions(spark):
    ins = spark.createDataFrame([("f", i) for i in range(10)], "file string, row_idx bigint")
    idx = spark.createDataFrame([("f", 0), ("f", 999)], "file string, row_idx bigint")
    row = reconcile(ins, ins.where("row_idx = 0"), idx).first()
    assert row.ok and row.index_rows == 2


def test_foreign_csv_and_hidden_archives(spark, tmp_dir):
    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write('text,n\n"a ""b"", c",1\n')
    assert read_split_files(spark, f"{tmp_dir}/t.csv").first().text == 'a "b", c'
    open(f"{tmp_dir}/_x.jsonl.zst", "wb").close()
    with pytest.raises(ValueError, match="hidden"):
        resolve_archive_files(spark, tmp_dir)


def test_tfrecord_append_keeps_rows(spark, tmp_dir):
    df = spark.createDataFrame([([1, 2],), ([3],)], "ids array<bigint>").coalesce(1)
    write_tfrecords(df, f"{tmp_dir}/tf")
    write_tfrecords(df, f"{tmp_dir}/tf")
    assert read_tfrecords(spark, f"{tmp_dir}/tf").count() == 4


def test_two_pass_filter_resumes(spark, tmp_dir):
    rec = records(spark, 30).withColumn("file", F.concat("file", F.lit(".jsonl.zst")))
    rec = rec.withColumn("text", F.when(F.col("row_idx") % 2 == 0, F.concat("text", F.lit(" long" * 50))).otherwise(F.col("text")))
    write_archive(rec.where("file < 'f2'"), f"{tmp_dir}/in", file_col="file", order_col="row_idx")
    report = two_pass_filter(spark, f"{tmp_dir}/in", f"{tmp_dir}/ix", f"{tmp_dir}/out", 50)
    assert sorted((r.file, r.out_rows, r.ok) for r in report.collect()) == [("f0.jsonl.zst", 5, True), ("f1.jsonl.zst", 5, True)]
    write_archive(rec.where("file >= 'f2'"), f"{tmp_dir}/in", file_col="file", order_col="row_idx")
    report = two_pass_filter(spark, f"{tmp_dir}/in", f"{tmp_dir}/ix", f"{tmp_dir}/out", 50)
    assert [r.file for r in report.collect()] == ["f2.jsonl.zst"]
    kept = {(r.file, r.text) for r in read_archive(spark, f"{tmp_dir}/out").collect()}
    assert kept == {(r.file, r.text) for r in rec.where("row_idx % 2 = 1").collect()}
    with pytest.raises(ValueError, match="share a name"):
        read_archive(spark, [f"{tmp_dir}/in", f"{tmp_dir}/out"])


def test_training_checks_and_first_sample(spark):
    cfg = BlockConfig(block_size=32, validation_percent=10, concatenate_texts=True, batch_rows=7)
    df = records(spark).select((F.col("row_idx") * 3 + F.substring("file", 2, 1).cast("int")).alias("row_idx"), "text")
    blocks, vocab = prepare_training_blocks(df, cfg)
    one = first_sample(blocks, vocab=vocab).first()
    assert one.segment.startswith("< DFF > d e 6") and one.segment in one.decoded
    with pytest.raises(ValueError, match="no train split"):
        prepare_training_blocks(df.withColumn("split", F.lit("validation")), cfg)


def test_records_are_read_once(spark, tmp_dir):
    table, counters, _ = archive_to_token_table(records(spark))
    for df in (table, counters):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp_extract_all" not in plan and "Scan json" not in plan, plan
