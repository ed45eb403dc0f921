"""Operator 6, quality classifier: sparse rule ensemble.

Statistics of each text (no labels, language, source or id among them) feed
shallow trees; every path from a root is a rule, a conjunction of thresholds;
a lasso logistic regression over the rules keeps few of them; those are
compiled into one Spark column expression over the statistics, which scores
every document.

Statistics are computed per text on arrays, in ``mapInArrow``; trees and lasso
are Spark ML on a sample of at most about ``SAMPLE`` labelled rows, chosen by
a hash of doc_id.

Null and empty texts have all statistics 0 and are scored like any other.
Null labels and null doc_ids are not learnt from; rows that repeat a doc_id
are each scored.  With fewer than two label values among the learnt rows the
score is their mean (0.5 without any).  Extra columns pass through ``score``
unless they have the name of a result, which takes their place;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.language import held_out
from tokenloom.llm.rows import packed, row_type, unpacked
from tokenloom.llm.tables import map_arrow, read
from tokenloom.llm.words import SpanHash, Words, chunks
from tokenloom.session import land

SAMPLE = 20_000
TREES = 20
DEPTH = 3
LASSO = 0.001
THRESHOLD = 0.7

STATISTICS = ["words_log", "word_bytes", "symbols", "marks", "capitals", "digits", "distinct", "repeats", "top_word", "line_repeats", "stops", "line_words"]


def _class(characters: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(characters.encode())] = 1
    return table


SYMBOLS, MARKS, STOPS = _class("#*$%&|<>@^~=_{}[]\\/+"), _class("!?"), _class(".,;:")
CAPITALS, DIGITS = _class("".join(map(chr, range(65, 91)))), _class("0123456789")
LETTERS = _class("".join(map(chr, [*range(65, 91), *range(97, 123)])))


def statistics_of(words: Words) -> np.ndarray:
    """One row of STATISTICS per text of a run."""
    rows, offsets, data = words.rows, words.offsets, words.data
    n_words = np.diff(rows)
    per_word = np.maximum(n_words, 1)
    out = np.zeros((len(n_words), len(STATISTICS)))

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    lengths = np.concatenate([[0], np.cumsum(words.end - words.start)])
    hashes = words.hashes(fold=True)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    same[rows[:-1][rows[:-1] < len(hashes)]] = False
    repeats = np.concatenate([[0], np.cumsum(same)])
    out[:, 0] = np.log1p(n_words)
    out[:, 1] = (lengths[rows[1:]] - lengths[rows[:-1]]) / per_word
    out[:, 2], out[:, 3] = total(SYMBOLS) / per_word, total(MARKS) / per_word
    out[:, 4] = total(CAPITALS) / np.maximum(total(LETTERS), 1)
    out[:, 5], out[:, 10] = total(DIGITS) / per_word, total(STOPS) / per_word
    out[:, 7] = (repeats[rows[1:]] - repeats[rows[:-1]]) / per_word
    out[:, 11] = n_words / (breaks[offsets[1:]] - breaks[offsets[:-1]] + 1)
    line_hash = SpanHash(data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for r in np.flatnonzero(n_words):
        own, counts = np.unique(hashes[rows[r]:rows[r + 1]], return_counts=True)
        out[r, 6], out[r, 8] = len(own) / n_words[r], counts.max() / n_words[r]
        cuts = np.flatnonzero(data[offsets[r]:offsets[r + 1]] == 10) + offsets[r]
        if len(cuts):
            lines = line_hash.of(np.concatenate([[offsets[r]], cuts + 1]), np.concatenate([cuts, [offsets[r + 1]]]))
            out[r, 9] = 1 - len(np.unique(lines)) / len(lines)
    return out


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the STATISTICS, which take the place of
    columns of their names."""
    schema = row_type(docs, [text_col]) + "".join(f", {s} double" for s in STATISTICS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in chunks(texts):
                found = statistics_of(Words(texts.slice(lo, hi - lo)))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *[pa.array(found[:, k].copy()) for k in range(len(STATISTICS))]],
                                      names=["row", *STATISTICS])

    rows = packed(docs, F.col(text_col).alias("text"), without=[text_col])
    return unpacked(map_arrow(rows, run, schema), docs.drop(text_col), STATISTICS)


Rule = tuple[tuple[str, str, float], ...]   # (statistic, "<=" or ">", threshold), sorted


def paths(node, names: list[str], above: dict) -> Iterable[Rule]:
    """The rules of a tree below ``node``: one per path, redundant thresholds merged."""
    if above:
        yield tuple(sorted((k, op, v) for (k, op), v in above.items()))
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    name, at = names[split.featureIndex()], float(split.threshold())
    yield from paths(node.leftChild(), names, {**above, (name, "<="): min(at, above.get((name, "<="), math.inf))})
    yield from paths(node.rightChild(), names, {**above, (name, ">"): max(at, above.get((name, ">"), -math.inf))})


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, op, at in rule:
        out = out & ((F.col(name) <= F.lit(at)) if op == "<=" else (F.col(name) > F.lit(at)))
    return out


class RuleEnsemble:
    """Weighted rules and an intercept; ``column()`` is the score."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def column(self) -> Column:
        margin = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            margin = margin + F.when(condition(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 6) -> RuleEnsemble:
    """From ``labelled(label, STATISTICS...)``, a landed bounded sample."""
    n, mean, low, high = labelled.agg(F.count(F.lit(1)), F.avg("label"), F.min("label"), F.max("label")).first()
    if not n or low == high:
        mean = 0.5 if not n else min(max(float(mean), 1e-3), 1 - 1e-3)
        return RuleEnsemble([], math.log(mean / (1 - mean)))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(labelled)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree._call_java("rootNode"), STATISTICS, {})})
    coded = labelled.select("label", *[condition(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    coded = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(coded).select("label", "features")
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(land(coded, "rule-features"))
    weights = model.coefficients.toArray()
    return RuleEnsemble([(r, w) for r, w in zip(rules, weights.tolist()) if w], float(model.intercept))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs(doc_id, text, ...)`` without the text, with ``held_out``, the
    STATISTICS, ``score`` and ``predicted``; learns from ``labels(doc_id, label)``
    of documents that are not held out."""
    stats = land(statistics(docs), "statistics")
    known = labels.where("label is not null and doc_id is not null").where(~held_out())
    n = known.count()
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(chance < min(1.0, sample / max(n, 1))).select("doc_id", F.col("label").cast("double").alias("label"))
    labelled = land(stats.select("doc_id", *STATISTICS).join(chosen, "doc_id").select("label", *STATISTICS).coalesce(4), "labelled")
    out = stats.withColumn("held_out", held_out()).withColumn("score", fit(labelled).column())
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return score(docs, labels).select("doc_id", "held_out", "score", "predicted")
