"""Operator 7, quality rules: a ledger of rule bits.

Every rule is evaluated once per document.  The ledger keeps the
measurements and one bit per failed rule; a policy is a named bit mask with
a version, and both a verdict and an ablation are bit operations on the
ledger, without another look at the texts.  Only DataFrame functions.

Null text: no words, every count 0, ``too_few_words`` fails.  Empty text:
the same.  Repeated rows and extra columns pass through unchanged.  An empty
table gives an empty ledger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.tables import read

SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks"]


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition over the measurements; ``bit`` never changes."""
    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``rules``."""
    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule(0, "too_few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbol_share", "10 * n_symbols > n_words"),
    Rule(3, "word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    Rule(4, "repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(5, "shouting_marks", "2 * n_marks > n_words"),
)
BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))
POLICIES = (BASE, STANDARD)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in policy.rules)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns computed once: as the output of a one-element ``explode`` they
    are not inlined into the expressions that read them."""
    packed = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_ledger_once")
    return df.select("*", packed).select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_ledger_once.{k}").alias(k) for k in columns])


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements as struct column ``ledger_measures``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(F.struct("*").alias("_row"), text.alias("_text"))
    d = _once(d, _words=F.regexp_extract_all("_text", F.lit("[^ \\t-\\r]+"), F.lit(0)),
              _lines=F.filter(F.split("_text", "\n", -1), lambda line: F.length(F.translate(line, SEPARATORS, "")) > 0),
              _chars=F.char_length("_text"))
    word = lambda i: "get(_words, i%s)" % (f" + {i}" if i else "")
    hashed = F.expr(f"transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({', '.join(word(i) for i in range(WINDOW))}))")
    d = _once(d, _windows=F.when(F.size("_words") >= WINDOW, hashed).otherwise(F.expr("cast(array() as array<bigint>)")))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = _once(d, _sorted=F.when(again, F.expr("sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i)))"))
              .otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)")))
    d = _once(d, _at=F.expr("sort_array(transform(filter(_sorted, (x, k) -> x.h <=> get(_sorted, k - 1).h OR x.h <=> get(_sorted, k + 1).h), x -> x.i))"))
    covered = F.expr(f"aggregate(transform(_at, (x, k) -> least({WINDOW}, coalesce(get(_at, k + 1) - x, {WINDOW}))), 0L, (s, x) -> s + x)")
    long = lambda c: c.cast("bigint")
    return d.select("_row.*", F.struct(
        long(F.size("_words")).alias("n_words"),
        long(_without(F.col("_text"), SEPARATORS)).alias("word_chars"),
        long(F.col("_chars") - _without(F.col("_text"), SYMBOLS)).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.col("_chars") - _without(F.col("_text"), "!")).alias("n_marks"),
    ).alias("ledger_measures"))


def ledger(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``ledger_measures`` and ``ledger_bits`` (bit set: rule failed)."""
    d = _once(measure(docs, text_col), _ledger_m=F.col("ledger_measures"))
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.col(f"_ledger_bit{r.bit}"), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
        d = d.withColumn(f"_ledger_bit{r.bit}", _over(r.failed))
    out = d.withColumn("ledger_bits", bits)
    return out.drop("_ledger_m", *[f"_ledger_bit{r.bit}" for r in rules])


def _over(condition: str) -> Column:
    """A rule's condition with its measurements taken from the struct ``_ledger_m``."""
    return F.expr(re.sub(r"\b(" + "|".join(MEASURES) + r")\b", r"_ledger_m.\1", condition))


def verdict(bits: Column | str, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """True if the policy keeps the document."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")) == 0


def apply_policies(led: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One boolean column ``<name>_v<version>`` per policy: kept."""
    return led.withColumns({f"{p.name}_v{p.version}": verdict("ledger_bits", p, rules) for p in policies})


def ablations(led: DataFrame, policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone,
    and that the policy keeps without it.  The ledger is first counted by its
    bits (at most 2**rules rows), then every rule reads those counts."""
    whole = mask(policy, rules)
    counts = led.groupBy("ledger_bits").agg(F.count(F.lit(1)).alias("_n"))
    bits = F.col("ledger_bits").bitwiseAND(F.lit(whole).cast("bigint"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).cast("bigint")
    chosen = [r for r in rules if r.name in policy.rules]
    row = counts.agg(*[F.struct(F.lit(r.name).alias("rule"),
                                total(bits.bitwiseAND(F.lit(1 << r.bit).cast("bigint")) != 0).alias("failed"),
                                total(bits == (1 << r.bit)).alias("failed_alone"),
                                total(bits.bitwiseAND(F.lit(whole & ~(1 << r.bit)).cast("bigint")) == 0).alias("kept_without"))
                       .alias(f"r{r.bit}") for r in chosen])
    return row.select(F.inline(F.array(*[f"r{r.bit}" for r in chosen])))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    led = apply_policies(ledger(docs))
    m = F.col("ledger_measures")
    return led.select("doc_id", *[m[c].alias(c) for c in MEASURES[:5]],
                      (~F.col("base_v1")).alias("base_failed"), F.col("standard_v1").alias("kept"),
                      F.col("ledger_bits").alias("failed_bits"))
