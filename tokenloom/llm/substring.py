"""Operator 9, substring dedup: relative Lempel-Ziv parsing against an index
of every block of the corpus.

A document is parsed into factors, each a stretch that some earlier document
(smaller id) also has; factors of at least ``window`` words are duplicate
spans, and their words go.

The index.  A document's windows of 50 words are cut into phrases at content
defined places: every window is named by the smallest hash of its 8-word
grams, and a run of windows with one name, with the words it covers, is a
phrase.  A phrase depends on its words alone, so equal stretches of any two
documents have the same phrases but for the two at the ends.  The index of
all blocks is the table ``(name, phrase hash) -> smallest doc_id``, hash
partitioned; a phrase is about 22 words longer than a window, so there are
about 22 times fewer entries than windows.

The parse.  (1) A phrase that the index gives to a smaller doc_id is copied
whole; neighbouring copied phrases join into one long factor.  (2) At factor
boundaries, where documents have the same name but different phrases, the
windows of the phrase are checked one by one against the windows of the
first documents of all other phrases of that name.  Equal windows have equal
names, so no window that also starts in a smaller document is missed, and
none else is found (up to a collision of 64-bit hashes).

Nothing is collected per name, phrase or window: all three are looked up by a
map-side aggregated minimum and an equi-join that Spark splits where a key is
hot.  Texts are shuffled only for documents with boundaries or copies.

Null text: no words; nothing is removed.  Null doc_id: never smaller than any
id and never larger, so nothing is removed and nothing refers to it.  Repeated
rows have the same id, so they do not remove each other; rows with one id are
taken for copies of one row (otherwise the spans of each are cut from all).
Extra columns pass through ``dedup``.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.rows import packed, row_type, unpacked
from tokenloom.llm.tables import forget, map_arrow, read, runtime_filters
from tokenloom.llm.words import SpanHash, Words, chunks, mix
from tokenloom.session import land

WINDOW = 50
GRAM = 8


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def phrases_of(words: Words, window: int = WINDOW, gram: int = GRAM):
    """``(row, name, phrase, first window, last window)`` of a run of texts,
    as arrays; windows are counted from the row's first word."""
    hashes = words.hashes()
    n = len(hashes)
    if n < window:
        return None
    spans = SpanHash(hashes)
    at = np.arange(n - gram + 1)
    names = sliding_min(mix(spans.of(at, at + gram) ^ np.uint64(0xA5A5A5A5A5A5A5A5)), window - gram + 1)
    row = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
    start = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
    if not len(start):
        return None
    names, owner = names[start], row[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    lo = np.flatnonzero(fresh)
    hi = np.append(lo[1:], len(start)) - 1
    phrase = spans.of(start[lo], start[hi] + window)
    base = words.rows[owner[lo]]
    return owner[lo], names[lo], phrase, start[lo] - base, start[hi] - base


def _phrases(batches: Iterable[pa.RecordBatch], window: int) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column(1)):
            found = phrases_of(Words(batch.column(1).slice(lo, hi - lo)), window)
            if found is not None:
                row, name, phrase, first, last = found
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(name.view(np.int64)),
                                       pa.array(phrase.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                                      names=["doc_id", "name", "phrase", "lo", "hi"])


def _expand(ranges: list) -> np.ndarray:
    """Distinct window starts of ``[(lo, hi)]``, both included."""
    return np.unique(np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in ranges]))


def _windows(batches: Iterable[pa.RecordBatch], window: int) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column("text")):
            words = Words(batch.column("text").slice(lo, hi - lo))
            spans = SpanHash(words.hashes())
            starts = [_expand(r) for r in batch.column("ranges").slice(lo, hi - lo).to_pylist()]
            row = np.repeat(np.arange(hi - lo), [len(s) for s in starts])
            local = np.concatenate(starts)
            at = local + words.rows[row]
            yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)),
                                   pa.array(spans.of(at, at + window).view(np.int64)), pa.array(local.astype(np.int32))],
                                  names=["doc_id", "window", "at"])


def _first(keyed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The smallest doc_id of each key that several documents have, landed."""
    low = keyed.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last_doc"))
    return land(low.where("first < last_doc").drop("last_doc"), name)


def copied_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, lo, hi)``: runs of windows of ``docs(doc_id, text)`` that also
    start in a document with a smaller id.  Landed."""
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null")
    schema = "doc_id bigint, name bigint, phrase bigint, lo int, hi int"
    phrases = land(map_arrow(docs.select("doc_id", "text"), lambda it: _phrases(it, window), schema), "phrases")
    # names that several documents have; ``mixed``: with different phrases
    names = land(phrases.groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                                             F.min("phrase").alias("p"), F.max("phrase").alias("q"))
                 .where("a < b").select("name", (F.col("p") != F.col("q")).alias("mixed")), "names")
    shared = land(phrases.join(names, "name"), "shared-phrases")
    forget(phrases)
    first = land(shared.groupBy("name", "phrase").agg(F.min("doc_id").alias("first")), "index")
    found = land(shared.join(first, ["name", "phrase"]).select("doc_id", "lo", "hi", "mixed", (F.col("first") < F.col("doc_id")).alias("copied")), "factors")
    copied = found.where("copied").select("doc_id", "lo", "hi")
    # boundaries: the first documents of phrases whose name has other phrases too
    ranges = land(found.where("mixed and not copied").groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "boundaries")
    with runtime_filters(spark):
        texts = docs.select("doc_id", "text").join(ranges.where("size(ranges) > 0"), "doc_id")
        windows = land(map_arrow(texts, lambda it: _windows(it, window), "doc_id bigint, window bigint, at int"), "windows")
    low = _first(windows, ["window"], "first-windows")
    single = windows.join(low, "window").where("first < doc_id").select("doc_id", F.col("at").alias("lo"), F.col("at").alias("hi"))
    out = land(copied.union(single), "copied-windows")
    for t in (names, shared, first, found, ranges, windows, low):
        forget(t)
    return out


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, spans)``: the disjoint word spans ``[start, end)``, in order,
    that windows of earlier documents cover.  One row per document that has any."""
    runs = copied_windows(docs, window).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"))
    merge = """
    aggregate(runs, cast(array() as array<struct<start:int,end:int>>), (s, r) ->
      CASE WHEN size(s) > 0 AND r.lo <= element_at(s, -1).end
        THEN concat(slice(s, 1, size(s) - 1), array(named_struct('start', element_at(s, -1).start, 'end', greatest(element_at(s, -1).end, r.hi + {w}))))
        ELSE concat(s, array(named_struct('start', r.lo, 'end', r.hi + {w}))) END)"""
    return runs.select("doc_id", F.expr(merge.format(w=window)).alias("spans"))


def _kept_mask(words: Words, row: int, spans: list | None) -> np.ndarray:
    keep = np.ones(words.rows[row + 1] - words.rows[row], bool)
    for s in spans or ():
        keep[s["start"]:s["end"]] = False
    return keep


def _cut(batches: Iterable[pa.RecordBatch], as_text: bool) -> Iterable[pa.RecordBatch]:
    """``(row, text, spans)`` to texts without the words of their spans; or to
    counts and a digest."""
    for batch in batches:
        for lo, hi in chunks(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            words = Words(part.column(1))
            data = words.data.tobytes()
            removed, texts, digests = [], [], []
            for i, spans in enumerate(part.column(2).to_pylist()):
                keep = _kept_mask(words, i, spans)
                removed.append(int(len(keep) - keep.sum()))
                which = words.rows[i] + np.flatnonzero(keep)
                if as_text:
                    texts.append(_keep_text(words, data, i, which, spans) if spans else part.column(1)[i].as_py())
                else:
                    kept = b" ".join([data[a:b] for a, b in zip(words.start[which].tolist(), words.end[which].tolist())])
                    digests.append(hashlib.sha256(kept).hexdigest())
            if as_text:
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])
            else:
                yield pa.record_batch([part.column(0), pa.array(np.diff(words.rows).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                                      names=["row", "n_words", "n_removed", "kept_sha256"])


def _keep_text(words: Words, data: bytes, row: int, which: np.ndarray, spans: list) -> str:
    """The text between the spans, as it stands; each cut leaves one line break."""
    base, end = words.rows[row], words.offsets[row + 1]
    pieces, at = [], int(words.offsets[row])
    last = int(words.rows[row + 1])
    for s in spans:
        first, after = base + s["start"], min(base + s["end"], last)
        if first < after:
            pieces.append(data[at:int(words.start[first])])
            at = int(words.end[after - 1])
    pieces.append(data[at:int(end)])
    return b"\n".join(p.strip(b" \t\n\x0b\x0c\r") for p in pieces if p.strip(b" \t\n\x0b\x0c\r")).decode()


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the duplicate spans cut out of ``text``; rows and all other
    columns, whatever their names, stay.  ``docs`` needs ``doc_id`` and ``text``."""
    out = map_arrow(_spanned(docs, window), lambda it: _cut(it, True), row_type(docs, ["text"]) + ", text string")
    return unpacked(out, docs, beside={"text": "text"})


def _spanned(docs: DataFrame, window: int) -> DataFrame:
    """``(row, text, spans)``."""
    spans = duplicate_spans(docs.select("doc_id", "text"), window).select(F.col("doc_id").alias("_of"), "spans")
    rows = packed(docs, F.col("text"), F.col("doc_id").alias("_id"), without=["text"])
    return rows.join(spans, F.col("_id") == F.col("_of"), "left").select("row", "text", "spans")


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    docs = docs.select("doc_id", "text")
    out = map_arrow(_spanned(docs, window), lambda it: _cut(it, False), "row struct<doc_id:bigint>, n_words bigint, n_removed bigint, kept_sha256 string")
    return out.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read(spark, sf_dir, "documents").select("doc_id", "text"))
