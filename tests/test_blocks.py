"""Packing and padding: FIXTURES.md section 5 hand cases, a list model,
and independence from the number of shuffle partitions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.constants import EOS_ID as E
from tokenloom.operators.blocks import pack_blocks, pad_blocks
from tokenloom.operators.checks import block_report

SCHEMA = "split string, row_idx bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"


def _table(spark, records, split="train"):
    rows = [(split, i, r, [1] * len(r), list(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, SCHEMA)


def _blocks(df, **kw):
    rows = df.orderBy("split", "batch_id", "block_id").collect()
    return [list(r["input_ids"]) for r in rows], rows


def model(records, block, batch_rows, keep_short=True):
    """The reference's group_texts per batch of ``batch_rows`` records."""
    out = []
    for b in range(0, len(records), batch_rows):
        stream = [x for r in records[b:b + batch_rows] for x in list(r) + [E]]
        total = len(stream)
        if total >= block:
            total = (total // block) * block
        elif not keep_short:
            total = 0
        out += [stream[i:i + block] for i in range(0, total, block)]
    return out


@pytest.mark.parametrize("records,expected", [
    ([[1, 2], [3, 4, 5]], [[1, 2, E, 3]]),
    ([[1]], [[1, E]]),
    ([[1, 2, 3]], [[1, 2, 3, E]]),
])
def test_pack_hand_cases(spark, records, expected):
    got, _ = _blocks(pack_blocks(_table(spark, records), 4, batch_rows=1000))
    assert got == expected


def test_pack_empty(spark):
    assert pack_blocks(_table(spark, []), 4).count() == 0


def test_pack_two_batches(spark):
    got, rows = _blocks(pack_blocks(_table(spark, [[1, 2, 3, 4], [5, 6, 7]]), 4, batch_rows=1))
    assert got == [[1, 2, 3, 4], [5, 6, 7, E]]
    assert [r["batch_id"] for r in rows] == [0, 1]


def test_pack_columns_and_report(spark):
    b = pack_blocks(_table(spark, [[1, 2], [3, 4, 5]]), 4)
    r = b.first()
    assert r["attention_mask"] == [1, 1, 0, 1] and r["labels"] == [1, 2, -100, 3]
    rep = block_report(b, 4).first()
    assert (rep["n_blocks"], rep["len_mismatch"], rep["wrong_size"]) == (1, 0, 0)


@settings(max_examples=12, deadline=None)
@given(lengths=st.lists(st.integers(min_value=0, max_value=12), min_size=0, max_size=25),
       block=st.integers(min_value=1, max_value=9),
       batch_rows=st.sampled_from([1, 2, 3, 7, 1000]),
       keep_short=st.booleans())
def test_pack_matches_model(spark, lengths, block, batch_rows, keep_short):
    records = [[100 * i + j for j in range(n)] for i, n in enumerate(lengths)]
    got, _ = _blocks(pack_blocks(_table(spark, records), block, batch_rows=batch_rows,
                                 keep_short=keep_short, bucket_rows=4))
    assert got == model(records, block, batch_rows, keep_short)


def test_pack_global_batch_and_gaps(spark):
    """batch_rows=None uses the two-level prefix sum; row_idx with gaps is
    renumbered densely before batching."""
    records = [[i] * (i % 5) for i in range(30)]
    rows = [("train", 3 * i + 11, r, [1] * len(r), list(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, _ = _blocks(pack_blocks(df, 4, batch_rows=None, bucket_rows=8))
    assert got == model(records, 4, len(records))
    got, _ = _blocks(pack_blocks(df, 4, batch_rows=6, bucket_rows=8))
    assert got == model(records, 4, 6)


def test_pack_in_many_parts(spark, monkeypatch):
    """Parts of a few records, two splits, gaps, and blocks longer than a part."""
    from tokenloom.operators import blocks
    monkeypatch.setattr(blocks, "PART_ROWS", 3)
    records = [[i] * (i % 7) for i in range(80)]
    rows = [(s, 5 * i - 100, r, [1] * len(r), list(r)) for s in ("train", "validation", None) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, SCHEMA)
    for block, batch in [(4, None), (50, None), (1000, None), (3, 2), (5, 7)]:
        out = pack_blocks(df, block, batch_rows=batch, bucket_rows=16).collect()
        for s in ("train", "validation", None):
            mine = sorted((r for r in out if r["split"] == s), key=lambda r: (r["batch_id"], r["block_id"]))
            assert [r["input_ids"] for r in mine] == model(records, block, batch or len(records)), (block, batch, s)


def test_pack_parallelism_independent(spark):
    records = [[i] * (i % 9) for i in range(60)]
    df = _table(spark, records)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one, _ = _blocks(pack_blocks(df, 5, batch_rows=7, bucket_rows=8))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        many, _ = _blocks(pack_blocks(df, 5, batch_rows=7, bucket_rows=8))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many == model(records, 5, 7)


def test_pad(spark):
    r = pad_blocks(_table(spark, [[7, 8]]), 4).first()
    assert r["input_ids"] == [E, E, 7, 8]
    assert r["attention_mask"] == [0, 0, 1, 1]
    assert r["labels"] == [-100, -100, 7, 8]
    with pytest.raises(Exception):
        pad_blocks(_table(spark, [[1, 2, 3, 4, 5]]), 4).collect()
    with pytest.raises(ValueError):
        pad_blocks(_table(spark, [[1]]).drop("labels"), 4)
