"""Vocabularies with versions, ids from a stream's state, archives of many
frames, patterns searched together."""

import glob
import os
import random
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tokenloom.constants import EOS_ID
from tokenloom.functions.arrays import find_all
from tokenloom.operators.patterns import Patterns, find_patterns
from tokenloom.operators.vocab import build_vocabulary, with_tokens
from tokenloom.operators.vocab_store import VocabularyStore, open_vocabulary, token_counts
from tokenloom.sinks.archive import write_archive
from tokenloom.sinks.frames import read_index
from tokenloom.sources.files import read_archive, read_frames
from tokenloom.streaming.new_tokens import stream_new_ids, with_new_ids


# --- vocabulary store -----------------------------------------------------------

def _counts(spark, text):
    return token_counts(with_tokens(spark.createDataFrame([(text,)], "text string")).select("tokens"))


def test_versions_keep_ids(spark, tmp_dir):
    store = open_vocabulary(spark, f"{tmp_dir}/v", _counts(spark, "b b b a a c"), "one")
    first = {r.token: r.id for r in store.read().collect()}
    assert first == {"b": 0, "a": 1, "c": 2, "<": 3, ">": 4, "DFF": 5}
    assert store.merge(_counts(spark, "z z z z b y y"), "two") == 1
    second = {r.token: (r.id, r.n) for r in store.read().collect()}
    assert {t: second[t][0] for t in first} == first
    assert second["z"] == (6, 4) and second["y"] == (7, 2) and second["b"] == (0, 4)
    assert store.merge(_counts(spark, "never seen"), "two") == 1 and len(store.manifest()) == 2
    assert {r.token: r.id for r in store.ids(0).collect()} == first
    t = spark.createDataFrame([(1, ["z", "a", "q"])], "k bigint, tokens array<string>")
    assert store.encode(t, ["k"], 0).first().input_ids == [-1, 1, -1]
    assert store.encode(t, ["k"], 1).first().input_ids == [6, 1, -1]
    # a later token that is frequent is in the head though its id is not
    head = store.head(head_rows=4)
    assert {"b", "a", "z"} <= set(head.entries.value["key"].to_pylist()) and not head.whole
    assert store.encode(t, ["k"], head=head).first().input_ids == [6, 1, -1]


def test_killed_merge_leaves_no_trace(spark, tmp_dir, monkeypatch):
    store = open_vocabulary(spark, f"{tmp_dir}/v", _counts(spark, "a b"), "one")
    before = store.read().collect()
    monkeypatch.setattr(VocabularyStore, "table", lambda self, version: (_ for _ in ()).throw(RuntimeError("killed")) if version else
                        self.spark.read.parquet(f"{self.path}/version={version}"))
    with pytest.raises(RuntimeError):
        store.merge(_counts(spark, "c d"), "two")          # the table is written, the manifest is not
    monkeypatch.undo()
    assert os.path.isdir(f"{tmp_dir}/v/version=1") and store.read().collect() == before
    assert store.merge(_counts(spark, "e"), "three") == 1
    assert sorted(r.token for r in store.table(1).collect()) == ["e"]


def test_first_version_equals_the_plain_vocabulary(spark, tmp_dir):
    rows = [(" ".join(f"t{i % (k + 1)}" for i in range(50)),) for k in range(40)]
    tokens = with_tokens(spark.createDataFrame(rows, "text string")).select("tokens")
    store = open_vocabulary(spark, f"{tmp_dir}/v", token_counts(tokens), "one")
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, build_vocabulary(tokens).collect()))


# --- stream -----------------------------------------------------------------------

def test_new_ids_over_a_restart(spark, tmp_dir):
    vocab = build_vocabulary(with_tokens(spark.createDataFrame([("known words",)], "text string")).select("tokens"))

    def archives(lo, hi):
        rows = [(k, f"a{k}.jsonl.zst", f"known new{k} new{k + 1} both") for k in range(lo, hi)]
        write_archive(spark.createDataFrame(rows, "k bigint, file string, text string"), f"{tmp_dir}/in", "file", "k")

    run = lambda: stream_new_ids(spark, f"{tmp_dir}/in", vocab, f"{tmp_dir}/ids", f"{tmp_dir}/ckpt", max_files_per_trigger=2, buckets=4)
    ids = lambda: {r.token: r.id for r in with_new_ids(vocab, f"{tmp_dir}/ids").collect()}
    archives(0, 4)
    run()
    first = ids()
    run()                                                   # nothing new
    assert ids() == first
    archives(4, 7)
    run()
    second = ids()
    assert {t: second[t] for t in first} == first
    assert set(second) == {"known", "words", "<", "DFF", ">", "both", *[f"new{k}" for k in range(8)]}
    assert with_new_ids(vocab, f"{tmp_dir}/ids").count() == len(second) == len(set(second.values())) and EOS_ID not in second.values()


# --- archives -----------------------------------------------------------------------

def test_one_archive_many_tasks(spark, tmp_dir):
    rows = [(k, "one.jsonl.zst" if k % 3 else f"f{k % 7}.jsonl.zst", f"text {k} " + "x" * (k % 50)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, file string, text string").repartition(7)
    write_archive(df, f"{tmp_dir}/out", "file", "k", frame_bytes=2000)
    assert sorted(os.listdir(f"{tmp_dir}/out")) == sorted({r[1] for r in rows})
    path = f"{tmp_dir}/out/one.jsonl.zst"
    entries = read_index(open(path, "rb"), os.path.getsize(path))
    assert sum(lines for _, lines in entries) == 2000 and any(lines == 0 for _, lines in entries[1:]), "made of several parts"
    back = read_frames(spark, [path], task_bytes=500)
    assert back.select(F.spark_partition_id()).distinct().count() >= 4
    want = sorted((f, t) for _, f, t in rows)
    got = {(r.file, r.row_idx): r.text for r in read_archive(spark, f"{tmp_dir}/out").collect()}
    for name in {r[1] for r in rows}:
        assert [got[name, k] for k in range(sum(f == name for f, _ in got))] == [t for _, f, t in rows if f == name]
    assert sorted((f, t) for (f, _), t in got.items()) == want
    # any zstd reader reads the file, Spark's own too
    with open(path, "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().count(b"\n") == 2000
    assert spark.read.schema("text string").json(f"{tmp_dir}/out/*.zst").count() == 3000
    with pytest.raises(FileExistsError):
        write_archive(df, f"{tmp_dir}/out", "file", "k")
    assert not glob.glob(f"{tmp_dir}/out/_temporary*")


def test_foreign_archives_without_index(spark, tmp_dir):
    lines = "".join('{"text": "t%d", "meta": {"a": 1}}\n' % k for k in range(5000))
    with open(f"{tmp_dir}/a.jsonl.zst", "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(lines[:60000].encode()) + zstandard.ZstdCompressor().compress((lines[60000:] + "\n").encode()))
    open(f"{tmp_dir}/b.jsonl.zst", "wb").write(zstandard.ZstdCompressor().compress(b'{"text": "last"}'))
    got = {(r.file, r.row_idx): r.text for r in read_archive(spark, tmp_dir).collect()}
    assert got == {**{("a.jsonl.zst", k): f"t{k}" for k in range(5000)}, ("b.jsonl.zst", 0): "last"}
    open(f"{tmp_dir}/c.jsonl.zst", "wb").write(zstandard.ZstdCompressor().compress(b'{"text": \n'))
    with pytest.raises(Exception):
        read_archive(spark, tmp_dir).collect()


# --- patterns -------------------------------------------------------------------------

def naive(a, patterns):
    return [(k, i) for i in range(len(a)) for k, p in enumerate(patterns) if a[i:i + len(p)] == p]


def test_patterns_match_naive_search(spark):
    r = random.Random(2)
    patterns = [["a"], ["a", "a"], ["a", "b", "a"], ["b", "a", "b", "a"], ["c"] * 3, ["a"] * 200, ["a", "b", "a"]]
    arrays = [None, [], ["x"] * 5, ["a"] * 450, ["a", "b"] * 60] + [r.choices("aabbcx", k=r.randint(0, 60)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(arrays)), "i bigint, tokens array<string>").repartition(3)
    for row in find_patterns(df, patterns).collect():
        assert [tuple(m) for m in row.matches] == naive(arrays[row.i] or [], patterns), row.i
    alone = find_patterns(df, [["a", "b", "a"]]).select("matches.start", find_all("tokens", ["a", "b", "a"]).alias("native"))
    assert alone.where("start <> native").count() == 0
    ints = spark.createDataFrame([([7, 8, 7, 8, 7],)], "tokens array<int>")
    assert [tuple(m) for m in find_patterns(ints, [[7, 8, 7]]).first().matches] == [(0, 0), (0, 2)]
    with pytest.raises(ValueError):
        find_patterns(df, [[]])


def test_pattern_search_is_linear():
    automaton = Patterns([["a"] * 199 + ["b"], ["a"] * 7, ["b"]])
    times = []
    for n in (500_000, 1_000_000):
        codes = np.ones(n, np.int64)
        codes[::1000] = 2
        t0 = time.perf_counter()
        automaton.find(codes, np.array([0, n]))
        times.append(time.perf_counter() - t0)
    assert times[1] < 4 * times[0]
