"""Sources and sinks: archives, TF records, index text, split files."""

import io
import json
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from tokenloom.sinks.archive import write_archive
from tokenloom.sinks.tables import write_index_text, write_text_json
from tokenloom.sinks.tfrecord import example_bytes, frame, read_records, read_tfrecords, write_tfrecords
from tokenloom.sources.files import (count_files, read_archive, read_index_text, read_split_files,
                                     resolve_archive_files)


def _archive(path, texts):
    with open(path, "wb") as fh:
        w = zstandard.ZstdCompressor().stream_writer(fh)
        for t in texts:
            w.write((json.dumps({"text": t, "meta": {"k": 1}}) + "\n").encode())
        w.close()


def test_read_archive_row_index(spark, tmp_dir):
    for k in range(4):
        _archive(f"{tmp_dir}/f{k}.jsonl.zst", [f"file{k} row{i}" for i in range(25 + k)])
    open(f"{tmp_dir}/other.json", "w").write("{}\n")
    rows = read_archive(spark, tmp_dir).collect()
    assert len(rows) == 4 * 25 + 6
    for r in rows:
        assert r["text"] == f"{r['file'][:-len('.jsonl.zst')]} row{r['row_idx']}".replace("f", "file", 1)


def test_resolve_errors(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        resolve_archive_files(spark, f"{tmp_dir}/missing")
    os.makedirs(f"{tmp_dir}/empty")
    with pytest.raises(ValueError):
        resolve_archive_files(spark, f"{tmp_dir}/empty")
    open(f"{tmp_dir}/x.txt", "w").write("a")
    with pytest.raises(ValueError):
        resolve_archive_files(spark, f"{tmp_dir}/x.txt")


def test_archive_roundtrip(spark, tmp_dir):
    texts = ['a "quoted"\nline', "b\r\nc", "über ✓", "last"]
    df = spark.createDataFrame([(i, f"s{i % 2}.jsonl.zst", t) for i, t in enumerate(texts)],
                               "i bigint, file string, text string")
    write_archive(df, f"{tmp_dir}/out", file_col="file", order_col="i")
    assert count_files(spark, f"{tmp_dir}/out", "*jsonl.zst") == 2
    back = {(r["file"], r["row_idx"]): r["text"] for r in read_archive(spark, f"{tmp_dir}/out").collect()}
    assert back == {("s0.jsonl.zst", 0): texts[0], ("s0.jsonl.zst", 1): texts[2],
                    ("s1.jsonl.zst", 0): texts[1], ("s1.jsonl.zst", 1): texts[3]}
    line = zstandard.ZstdDecompressor().stream_reader(open(f"{tmp_dir}/out/s0.jsonl.zst", "rb")).read()
    assert json.loads(line.split(b"\n")[0]) == {"text": texts[0], "meta": {}}


def test_tfrecord_roundtrip(spark, tmp_dir):
    seqs = [[1, 2, 3], [], [50256, 7], list(range(300))]
    df = spark.createDataFrame([(s,) for s in seqs], "ids array<int>").repartition(2)
    write_tfrecords(df, f"{tmp_dir}/tf", name="data")
    names = os.listdir(f"{tmp_dir}/tf")
    assert names and all(n.startswith("data_4.tfrecords") for n in names)
    back = sorted(list(r["ids"]) for r in read_tfrecords(spark, f"{tmp_dir}/tf").collect())
    assert back == sorted(seqs)


def test_index_text_roundtrip(spark, tmp_dir):
    idx = spark.createDataFrame([("a.jsonl.zst", i) for i in (5, 0, 2)] + [("b.jsonl.zst", 1)],
                                "file string, row_idx bigint")
    write_index_text(idx, f"{tmp_dir}/idx", chunk_rows=2)
    back = sorted((r["file"], r["row_idx"]) for r in read_index_text(spark, f"{tmp_dir}/idx").collect())
    assert back == [("a.jsonl.zst", 0), ("a.jsonl.zst", 2), ("a.jsonl.zst", 5), ("b.jsonl.zst", 1)]
    os.makedirs(f"{tmp_dir}/foreign")
    open(f"{tmp_dir}/foreign/c.jsonl.zst", "w").write("[[0, 2], None, [5]]")
    back = sorted(r["row_idx"] for r in read_index_text(spark, f"{tmp_dir}/foreign").collect())
    assert back == [0, 2, 5]


def test_split_files(spark, tmp_dir):
    write_text_json(spark.createDataFrame([("x",), ("y",)], "text string"), f"{tmp_dir}/t.json")
    with open(f"{tmp_dir}/v.txt", "w") as fh:
        fh.write("l1\nl2\nl3\n")
    df = read_split_files(spark, f"{tmp_dir}/t.json", f"{tmp_dir}/v.txt", keep_linebreaks=True)
    got = sorted((r["split"], r["text"]) for r in df.collect())
    assert got == [("train", "x"), ("train", "y"), ("validation", "l1\n"), ("validation", "l2\n"),
                   ("validation", "l3\n")]
    with pytest.raises(ValueError):
        read_split_files(spark, f"{tmp_dir}/t.parquet")
    flat = read_split_files(spark, None, f"{tmp_dir}/v.txt", keep_linebreaks=False)
    assert sorted(r["text"] for r in flat.collect()) == ["l1", "l2", "l3"]
    assert flat.where(F.col("split") == "validation").count() == 3


def test_tfrecords_are_read_one_at_a_time():
    records = [example_bytes(range(k)) for k in (0, 3, 500)]

    class Stream(io.BytesIO):
        most = 0

        def read(self, n=-1):
            data = super().read(n)
            self.most = max(self.most, len(data))
            return data
    data = b"".join(map(frame, records * 20))
    stream = Stream(data)
    assert list(read_records(stream)) == records * 20 == list(read_records(data))
    assert stream.most == len(records[2]) + 4
    with pytest.raises(ValueError):
        list(read_records(data[:-1]))
