"""Extra columns with the names that operators use inside, and tables without rows."""

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import bpe, html, jaccard, language, mixing, quality, rules, runs, substring

NAMES = ["row", "text_", "n_tokens", "ids", "round_trip", "decoded", "score", "lang_pred", "digits", "symbols", "copies", "copy", "_n", "n", "id", "_id", "size", "_size",
         "spans", "_spans", "_of", "_spans_of", "_keep", "key", "node", "group", "runs", "words", "part", "rank", "block", "held_out", "predicted", "kept", "_m", "nothing"]


def table(spark, without=()):
    names = [n for n in NAMES if n not in without]
    rows = [(i, f"the quick brown fox number {i % 7} jumps over the lazy dog again and again", "en", f"s{i % 3}") for i in range(30)] + [(None, None, None, None), (3, "", "en", "s0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names]), names


OPERATORS = {
    "encode": lambda d: bpe.encode(d, check=True),
    "decode": lambda d: bpe.decode(bpe.encode(d).select(*[c for c in d.columns if c not in ("n_tokens", "ids")], "ids")),
    "predict": lambda d: language.predict(d, language.vocabulary(), [], __import__("numpy").zeros((1, 0))),
    "statistics": quality.statistics,
    "mixed": mixing.mixed_documents,
    "dedup": lambda d: substring.dedup(d, 10),
    "one_of_each": jaccard.one_of_each,
    "ledger": rules.ledger,
    "collapse": runs.collapse,
    "html": lambda d: html.extract(d, "text"),
}
RESULTS = {"encode": ["n_tokens", "ids", "round_trip"], "decode": ["n_tokens", "ids", "decoded"], "predict": ["lang_pred", "score"], "statistics": quality.STATISTICS, "html": ["n_chars"]}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_extra_columns_pass_through(spark, name):
    df, names = table(spark)
    out = OPERATORS[name](df)
    for r in out.limit(40).collect():
        for n in names:
            if n not in RESULTS.get(name, ()) and n in out.columns:
                assert r[n] == f"own {n}", n
    assert {n for n in names if n not in RESULTS.get(name, ())} <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))
    assert OPERATORS[name](df.limit(0)).collect() == []
