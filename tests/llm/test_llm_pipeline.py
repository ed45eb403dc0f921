"""The pipeline and the twins on a small scale factor."""

import sys

from oracle_check import compare
from pyspark.sql import functions as F

sys.path.insert(0, "/root/repo")
import corpus_pipeline  # noqa: E402
from test_llm_dedup import brute_spans, corpus, words  # noqa: E402
from tokenloom.llm import rules, substring  # noqa: E402
from tokenloom.llm.registry import ORACLE, QUERIES  # noqa: E402
from tokenloom.llm.tables import read  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_twins(spark):
    assert len(QUERIES) == 14 and set(ORACLE) <= set(QUERIES)
    bad = {k: v for k, v in compare(spark, SF, list(ORACLE)).items() if v[0] != "OK"}
    assert not bad, bad


def test_stages_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SF)
    bits = {r.doc_id: r.ledger_bits for r in rules.ledger(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, b in bits.items() if b == 0}
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    single = stages["ngram_jaccard"](spark, kept, SF)
    alone = brute_kept(rows, 80, 5)
    rows = [(i, t) for i, t in rows if i in alone]
    assert sorted((r.doc_id, r.text) for r in single.collect()) == rows
    cut = stages["substring_dedup"](spark, single, SF)
    want = {i: (n, k) for i, n, k, _ in brute_spans(rows, substring.WINDOW)}
    for r in cut.collect():
        assert len(words(r.text)) == want[r.doc_id][0] - want[r.doc_id][1] and r.n_chars == len(r.text)
    mixed = stages["mix_sources"](spark, cut, SF)
    assert mixed.columns == cut.columns == docs.columns
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    last = stages["bpe_codec"](spark, mixed, SF)
    assert last.count() == mixed.count() and last.where("not round_trip").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("not round_trip or n_tokens <> size(ids)").count() == 0


def brute_kept(rows, percent, width):
    """Ids that are the smallest of their group, all pairs compared."""
    sets = {}
    for i, t in rows:
        w = words((t or "").lower())
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return {i for i, g in group.items() if i == g}


def test_near_duplicates_of_five_words_and_080(spark):
    base = [f"w{k}" for k in range(126)]
    # 1001 has 22 words appended: 100 of 122 shingles, 0.82; 1002 has 26: 100 of 126 with 1000, but 0.97 with 1001
    planted = [(1000, base[:104]), (1001, base), (1002, base + ["x", "y", "z", "q"]), (1003, [f"v{k}" for k in range(104)]), (1004, [f"v{k}" for k in range(131)])]
    rows = corpus(3)[:40] + [(i, " ".join(w)) for i, w in planted]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs.repartition(5), SF).collect()}
    assert kept == brute_kept(rows, 80, 5) and {1000, 1001, 1002, 1003, 1004} & kept == {1000, 1003, 1004}
