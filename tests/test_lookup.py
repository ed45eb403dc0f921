"""Lookup inside the row: the head's size never changes the result."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.constants import EOS_ID, UNKNOWN_ID
from tokenloom.operators.lookup import pieces
from tokenloom.operators.vocab import build_vocabulary, decode, encode, vocabulary_head, with_tokens
from tokenloom.session import BATCH_ROWS

LONG = "w" * 3000
TEXTS = ["a a a b c", "", None, f"{LONG} a {LONG} b", "d e f g h i j k l a", "ü é ü " + "é" * 70, "a b c"]


@pytest.mark.parametrize("head_rows", [1, 4, 1 << 19])
def test_head_and_tail_agree(spark, head_rows):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "key bigint, text string")
    t = with_tokens(df).select("key", "text", "tokens")
    vocab = build_vocabulary(t.select("tokens"), extra_tokens=())
    ids = {r.token: r.id for r in vocab.collect()}
    want = {r.key: (r.text, [ids[x] for x in r.tokens]) for r in t.collect()}
    head = vocabulary_head(vocab, head_rows)
    assert head.whole == (len(ids) <= head_rows)
    enc = encode(t, vocab, ["key"], head=head)
    assert {r.key: (r.text, r.input_ids) for r in enc.collect()} == want
    assert all(r.attention_mask == [1] * len(r.input_ids) for r in enc.collect())
    dec = decode(enc.drop("attention_mask"), vocab, ["key"], head_rows=head_rows)
    back = {r.key: r.decoded for r in dec.collect()}
    assert back == {r.key: " ".join(r.tokens) for r in t.collect()}


@pytest.mark.parametrize("head_rows", [1, 1 << 19])
def test_unknown_and_reserved(spark, head_rows):
    t = spark.createDataFrame([(0, ["a", "a", "b"])], "k bigint, tokens array<string>")
    vocab = build_vocabulary(t, extra_tokens=())
    new = spark.createDataFrame([(0, ["a", "zz", "b", LONG]), (1, []), (2, None), (3, ["zz"])], "k bigint, tokens array<string>")
    enc = encode(new, vocab, ["k"], head=vocabulary_head(vocab, head_rows))
    assert {r.k: r.input_ids for r in enc.collect()} == {0: [0, UNKNOWN_ID, 1, UNKNOWN_ID], 1: [], 2: [], 3: [UNKNOWN_ID]}
    ids = spark.createDataFrame([(0, [0, EOS_ID, 1, UNKNOWN_ID, 0]), (1, None)], "k bigint, input_ids array<int>")
    assert {r.k: r.decoded for r in decode(ids, vocab, ["k"], head_rows=head_rows).collect()} == {0: "a b a", 1: ""}


def test_no_row_per_token(spark):
    t = spark.createDataFrame([(0, ["a", "b"])], "k bigint, tokens array<string>")
    plan = encode(t, build_vocabulary(t), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange|Generate", plan), plan


def test_batches_are_cut_by_elements():
    rows = [["x"] * 100] * 10 + [None, [], ["y"] * 1000, ["z"]]
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.string()))], names=["k", "t"])
    cut = list(pieces([batch, batch], "t", 250))
    assert [k for b in cut for k in b["k"].to_pylist()] == 2 * list(range(len(rows)))
    assert [b["t"].to_pylist() for b in cut if b.num_rows == 1] == [[["y"] * 1000], [["z"]]] * 2
    assert all(b.num_rows == 1 or len(b["t"].flatten()) <= 250 for b in cut)


def test_arrow_batches_of_an_encoding_session_are_bounded(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for given, kept in (("10000", str(BATCH_ROWS)), ("0", str(BATCH_ROWS)), ("7", "7")):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", given)
            t = spark.range(5).select(F.col("id").alias("k"), F.array(F.col("id").cast("string")).alias("tokens"))
            encode(t, build_vocabulary(t), ["k"])
            assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == kept
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("landed", [False, True])
def test_tail_of_repeated_and_null_keys(spark, landed, tmp_dir):
    """Null elements are unknown; a row of a null or empty array stays."""
    t = spark.createDataFrame([(0, ["a", None, "b", "b", "c"]), (1, [None]), (2, []), (3, None), (4, ["c", "a"])], "k bigint, tokens array<string>")
    t.write.parquet(f"{tmp_dir}/t")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, id bigint")
    enc = encode(spark.read.parquet(f"{tmp_dir}/t"), vocab, ["k"], head=vocabulary_head(vocab, 1), landed=landed)
    assert {r.k: r.input_ids for r in enc.collect()} == {0: [0, UNKNOWN_ID, 1, 1, 2], 1: [UNKNOWN_ID], 2: [], 3: [], 4: [2, 0]}
