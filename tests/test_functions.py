"""Scalar and array expressions against hand cases (FIXTURES.md 4, 5)."""

import pytest
from pyspark.sql import functions as F

from tokenloom.constants import EOS_ID, IGNORE_LABEL
from tokenloom.functions.arrays import (argmax, find_all, find_first, first_unmasked_segment,
                                        left_pad, mask_before, shifted_matches)
from tokenloom.functions.text import integers_in_text, marker_tokens, tokenize

# the six subsequence vectors plus the edge cases
VECTORS = [
    ("aaaaaaaa", "aa", [0, 1, 2, 3, 4, 5, 6]),
    ("abdabeabfabc", "abc", [9]),
    ("aaabaacbaab", "aab", [1, 8]),
    ("111", "11", [0, 1]),
    ("ABC ABCDAB ABCDABCDABDE", "ABCDABD", [15]),
    ("ab", "abc", []),
    ("abc", "abc", [0]),
    ("abcabc", "x", []),
]


def _chars(s):
    return F.array(*[F.lit(c) for c in s]) if s else F.array().cast("array<string>")


@pytest.mark.parametrize("seq,pat,expected", VECTORS)
def test_find_all_vectors(spark, seq, pat, expected):
    row = spark.range(1).select(find_all(_chars(seq), list(pat)).alias("p"),
                                find_first(_chars(seq), list(pat)).alias("f")).first()
    assert list(row["p"]) == expected
    assert row["f"] == (expected[0] if expected else None)


def test_empty_pattern_raises():
    with pytest.raises(ValueError):
        find_all("x", [])


def test_tokenize_and_marker(spark):
    row = spark.range(1).select(tokenize(F.lit("a\tb <DFF> c_d, e")).alias("t")).first()
    assert row["t"] == ["a", "b", "<", "DFF", ">", "c_d", ",", "e"]
    assert marker_tokens() == ["<", "DFF", ">"]
    assert spark.range(1).select(F.size(tokenize(F.lit(None).cast("string")))).first()[0] == 0


def test_mask_cases(spark):
    ids = F.array(*[F.lit(x) for x in [9, 8, 3, 4, 5]])
    row = spark.range(1).select(
        mask_before(ids, find_first(ids, [3, 4])).alias("m"),
        mask_before(ids, find_first(ids, [7, 7])).alias("none")).first()
    assert row["m"] == [IGNORE_LABEL, IGNORE_LABEL, 3, 4, 5]
    assert row["none"] == [IGNORE_LABEL]


def test_pad_and_error(spark):
    row = spark.range(1).select(left_pad(F.array(F.lit(7), F.lit(8)), 4, EOS_ID).alias("p")).first()
    assert row["p"] == [EOS_ID, EOS_ID, 7, 8]
    with pytest.raises(Exception):
        spark.range(1).select(left_pad(F.array(*[F.lit(i) for i in range(5)]), 4, EOS_ID)).collect()


def test_first_unmasked_and_argmax(spark):
    lab = F.array(*[F.lit(x) for x in [-100, -100, 5, 6, -100, 7]])
    tail = F.array(*[F.lit(x) for x in [-100, 5, 6]])
    allm = F.array(F.lit(-100))
    s1, e1 = first_unmasked_segment(lab)
    s2, e2 = first_unmasked_segment(tail)
    s3, e3 = first_unmasked_segment(allm)
    r = spark.range(1).select(s1, e1, s2, e2, s3, e3,
                              argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("am")).first()
    assert tuple(r)[:6] == (2, 4, 1, 3, None, None)
    assert r["am"] == 1


def test_shifted_matches(spark):
    t, h = shifted_matches(F.array(F.lit(1), F.lit(2), F.lit(3)), F.array(F.lit(0), F.lit(1), F.lit(-100)))
    r = spark.range(1).select(t, h).first()
    assert tuple(r) == (2, 1)


def test_index_text(spark):
    r = spark.range(1).select(integers_in_text(F.lit("[[0, 2], None, [5]]")).alias("x")).first()
    assert r["x"] == [0, 2, 5]
