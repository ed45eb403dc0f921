"""Rule ledger and mixing: edge cases and invariants."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import mixing, rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string"


def brute_measures(text):
    import re
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    where = defaultdict(list)
    for k in range(len(w) - 4):
        where[tuple(w[k:k + 5])].append(k)
    covered = {p + d for at in where.values() if len(at) > 1 for p in at for d in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", "  \n\t", "one two", "a b c d e a b c d e f", "x " * 40, "l1\nl1\n\nl2\nl1", "é#漢 *$ <|>\x0b\x0c!",
         "The quick brown fox jumps over the lazy dog near the river bank today", "WOW!! " * 12, "q w e r t y " * 3000]


def test_ledger_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t, "en", "s", "clash") for i, t in enumerate(TEXTS)], SCHEMA)
    led = rules.ledger(df)
    for r in led.collect():
        assert tuple(r.ledger_measures)[:5] == brute_measures(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        n, _, _, _, rep = tuple(r.ledger_measures)[:5]
        assert bool(r.ledger_bits & 3) == (n < 10 or 100 * rep > 20 * n)
        assert r.n_words == "clash"
    assert rules.ledger(df.limit(0)).collect() == []


def test_ablations_agree_with_verdicts(spark):
    led = rules.ledger(spark.createDataFrame([(i, t, "en", "s", "") for i, t in enumerate(TEXTS)], SCHEMA))
    for row in rules.ablations(led).collect():
        bit = next(1 << r.bit for r in rules.RULES if r.name == row.rule)
        bits = [r.ledger_bits for r in led.collect()]
        assert row.failed == sum(b & bit != 0 for b in bits)
        assert row.failed_alone == sum(b == bit for b in bits)
        assert row.kept_without == sum(b & ~bit == 0 for b in bits)


def plain_targets(sizes, weights, share):
    t, capped = [0.0] * len(sizes), set()
    while True:
        left = share * sum(sizes) - sum(2 * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        t = [2.0 * sizes[i] if i in capped else left * weights[i] / w for i in range(len(sizes))]
        more = {i for i in range(len(sizes)) if t[i] > 2 * sizes[i] + 1e-9} - capped
        if not more:
            return t
        capped |= more


@pytest.mark.parametrize("n", [7, 700])
def test_mix_meets_targets(spark, n):
    rows = [(i, " ".join(["w"] * (1 + i * 7919 % 90)), "en", None if i % 7 == 0 else f"s{min(i % 23, 6)}", "") for i in range(n)]
    rows += [(n, None, "en", "s1", ""), (n + 1, "", "en", "zz", ""), (3, "w w w", "en", "s3", ""), (3, "w w w", "en", "s3", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    first, again = [sorted(map(tuple, mixing.mix(d).collect()), key=str) for d in (df, df.repartition(5))]
    assert first == again and len(first) == len(rows)
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    size, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for _, source, s, source_size, goal, copies in first:
        assert 0 <= copies <= 2
        size[source] += s
        taken[source] += copies * s
        largest[source] = max(largest[source], s)
        target[source] = goal
    want = plain_targets([size[s] for s in sources], [(3, 1, 2)[k % 3] for k in range(len(sources))], 1.5)
    for s, w in zip(sources, want):
        assert abs(target[s] - w) < 1e-6 * max(1, w)
        assert abs(taken[s] - target[s]) <= largest[s]


def test_rows_of_one_id_are_dealt_apart(spark):
    rows = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    out = mixing.mix(rows)
    n, taken, target = out.agg(F.count(F.lit(1)), F.sum(F.col("copies") * F.col("size")), F.max("target")).first()
    assert n == 100_000 and abs(taken - target) <= 3
    salted = mixing._salted(rows.select("doc_id", "source", F.lit(3).cast("bigint").alias("size")))
    assert salted.select("salt").distinct().count() == 100_000


def test_mixed_documents_repeat_rows(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 5)), "en", f"s{i % 3}", "c") for i in range(60)] + [(None, "a b", "en", "s0", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    want = {(r.doc_id, r.copies) for r in mixing.mix(df).where("copies > 0").collect()}
    got = {(r.doc_id, r.n) for r in out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed_documents(df.limit(0)).collect() == []
