"""The stream's output equals the batch producer; a restart adds nothing."""

from pyspark.sql import functions as F

from tokenloom.plans.flows import archive_to_token_table
from tokenloom.plans.records import diff_records
from tokenloom.sinks.archive import write_archive
from tokenloom.sources.files import read_archive
from tokenloom.streaming.chunks import stream_masked

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((r["file"], r["row_idx"], tuple(r["input_ids"]), tuple(r["labels"])) for r in
                  df.select("file", "row_idx", "input_ids", "labels").collect())


def test_stream_equals_batch(spark, tmp_dir):
    rec = diff_records(spark, SF).withColumn("file", F.concat("source", F.lit(".jsonl.zst")))
    write_archive(rec, f"{tmp_dir}/arch", file_col="file", order_col="doc_id")
    batch, counters, vocab = archive_to_token_table(read_archive(spark, f"{tmp_dir}/arch"), max_tokens=2048)
    c = counters.first()
    assert c["total"] == 200 and c["without_dff"] == 20
    stream_masked(spark, f"{tmp_dir}/arch", vocab, f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                  max_tokens=2048, max_files_per_trigger=6)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted(r["batch"] for r in out.select("batch").distinct().collect()) == [0, 1, 2, 3]
    expected = _rows(batch)
    assert _rows(out) == expected
    # restart from the same checkpoint: nothing new to do, no rows added
    stream_masked(spark, f"{tmp_dir}/arch", vocab, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", max_tokens=2048)
    assert _rows(spark.read.parquet(f"{tmp_dir}/out")) == expected
