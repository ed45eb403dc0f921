"""Operator 1, language ID: segmentation-marginalised unigrams.

Every language has one probability per piece of a fixed public vocabulary.  A
word's probability is the sum over all ways to cut it (with a leading space)
into pieces, computed by the forward algorithm; a text's is the product over
its words.  The prediction is the language of the highest probability, the
score its posterior under equal priors.

Pieces are byte strings (the longest of the vocabulary at hand has 25 bytes);
the vocabulary's byte pieces make every word possible.  Texts are lower-cased.
A word is scored whole, however long: the forward vector is scaled down every
``RESCALE`` bytes and the logarithms of the factors are added up.  Each word is
scored once per run of texts, for all languages at once, on arrays of words
of one length (long ones: of about one length) at a time.

Learning: expectation-maximisation.  The word counts of a sample of labelled
rows (about ``SAMPLE`` documents of each language, by a hash of doc_id; fewer
if there are fewer) are one Spark aggregation; each iteration is another one
that sends back at most (pieces x languages) expected counts.  Learning alone
cuts runs without white space into stretches of ``STRETCH`` bytes.

Null text, or one without a letter: ``und`` with score 0.  Null lang: not
learnt from.  Null doc_id: not learnt from, ``held_out`` false.  Repeated rows
and extra columns pass through (a result takes the place of a column of its
name); an empty table, or one without languages,
gives ``und`` throughout.  Ties go to the first language by code point.
"""

from __future__ import annotations

import math
from functools import lru_cache
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.rows import packed, row_type, unpacked
from tokenloom.llm.tables import map_arrow, read
from tokenloom.llm.words import SpanHash, Words, chunks
from tokenloom.session import land

VOCABULARY = "piece_bpe_32k.model"
STRETCH = 64           # bytes of a word that is learnt from
RESCALE = 16
CELLS = 1 << 20        # bytes of the words that are scored at once
SCALE = 1000.0         # probabilities are kept times SCALE per byte, within the range of doubles
SAMPLE = 1500
ROUNDS = 3
SMOOTHING = 0.1        # added to every expected count
REMEMBERED = 400_000   # words of which a worker keeps the scores


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def vocabulary(path: str | None = None) -> list[bytes]:
    """Distinct pieces as bytes, a leading space for the word mark; the 256 single bytes first."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path(VOCABULARY))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i).replace("▁", " ").encode() for i in ids}
    return [bytes([b]) for b in range(256)] + sorted(p for p in pieces if len(p) > 1)


class Pieces:
    """Hash table of the vocabulary and its prefixes, and the matches of pieces
    in arrays of words."""

    PREFIX = -2   # of a piece, but none itself

    def __init__(self, vocab: list[bytes]):
        self.longest = max(map(len, vocab), default=1)
        values = {p[:k]: self.PREFIX for p in vocab for k in range(2, len(p))}
        values.update((p, k) for k, p in enumerate(vocab) if len(p) > 1)
        entries = list(values)
        lengths = np.array([len(e) for e in entries])
        ends = np.cumsum(lengths)
        keys = np.zeros(len(entries), np.uint64)
        if entries:
            sums, inverse = self._sums(np.frombuffer(b"".join(entries), np.uint8))
            keys = (sums[ends] - sums[ends - lengths]) * inverse[ends - lengths] + lengths.astype(np.uint64)
        self.shift = np.uint64(64 - (8 * len(entries) + 1).bit_length())
        self.keys = np.zeros(1 << (64 - int(self.shift)), np.uint64)
        self.values = np.full(len(self.keys), -1, np.int32)
        given = np.fromiter(values.values(), np.int32, len(values))
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):   # a free slot takes the first of those that want it, the others go on to the next
            free = self.values[slots[left]] == -1
            chosen = left[free][np.unique(slots[left][free], return_index=True)[1]]
            self.keys[slots[chosen]], self.values[slots[chosen]] = keys[chosen], given[chosen]
            left = np.setdiff1d(left, chosen)
            slots[left] = (slots[left] + 1) % len(self.keys)

    @staticmethod
    def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = SpanHash(data.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        return own.sums, own.inverse

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry's piece, ``PREFIX``, or -1."""
        slot = self._slot(keys)
        out = self.values[slot]
        other = np.flatnonzero((out != -1) & (self.keys[slot] != keys))
        while len(other):
            slot[other] = (slot[other] + 1) % len(self.keys)
            out[other] = self.values[slot[other]]
            other = other[(out[other] != -1) & (self.keys[slot[other]] != keys[other])]
        return out

    def matches(self, words: list[bytes]) -> tuple[np.ndarray, list]:
        """``(lengths, steps)`` of words, the longest first: a step ``(i, j, rows,
        pieces)`` says that the piece stands at bytes ``i:j`` of the row.  Steps
        come by ``i``; a row is looked up as long as its bytes begin a piece."""
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        (sums, inverse), base, steps = self._sums(data), np.cumsum(lengths) - lengths, []
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")     # rows longer than i
        for i, n in enumerate(active.tolist()):
            steps.append((i, i + 1, slice(0, n), data[base[:n] + i].astype(np.int64)))
            rows, start, factor = np.arange(n), sums[base[:n] + i], inverse[base[:n] + i]
            for j in range(i + 2, min(int(lengths[0]), i + self.longest) + 1):
                inside = lengths[rows] >= j
                if not inside.all():
                    rows, start, factor = rows[inside], start[inside], factor[inside]
                found = self.find((sums[base[rows] + j] - start) * factor + np.uint64(j - i))
                hit = found >= 0
                if hit.any():
                    steps.append((i, j, rows[hit], found[hit]))
                on = found != -1
                rows, start, factor = rows[on], start[on], factor[on]
                if not len(rows):
                    break
        return lengths, steps


def scaled(probabilities: np.ndarray, vocab: list[bytes]) -> np.ndarray:
    return probabilities * np.power(SCALE, [len(p) for p in vocab])[:, None]


def forward(length: int, steps: list, n: int, scaled_p: np.ndarray) -> np.ndarray:
    """``alpha[k]``: summed probability of all segmentations of the first ``k`` bytes."""
    alpha = np.zeros((length + 1, n, scaled_p.shape[1]))
    alpha[0] = 1
    for i, j, rows, pieces in steps:
        alpha[j, rows] += alpha[i, rows] * scaled_p[pieces]
    return alpha


def log_totals(lengths: np.ndarray, steps: list, scaled_p: np.ndarray, longest: int) -> np.ndarray:
    """Logarithm of each word's summed probability, scaled; words the longest
    first.  ``forward`` with the vectors ahead scaled down on the way."""
    n, size = len(lengths), longest + 1
    alpha = np.zeros((size, n, scaled_p.shape[1]))       # of the next bytes, by place modulo size
    alpha[0] = 1
    logs, out, at = np.zeros((n, scaled_p.shape[1])), np.zeros((n, scaled_p.shape[1])), -1
    shortest = n
    for i, j, rows, pieces in steps:
        if i != at:
            at = i
            left = rows.stop                              # rows that go on; those of length i are done
            if left < shortest:
                done = slice(left, shortest)
                out[done] = np.log(np.maximum(alpha[i % size, done], 1e-300)) + logs[done]
                shortest = left
            if i and i % RESCALE == 0:
                factor = alpha[i % size, :left].copy()
                alpha[:, :left] /= factor
                logs[:left] += np.log(factor)
            if i:
                alpha[(i - 1) % size] = 0                 # its place is now that of byte i + longest
        alpha[j % size, rows] += alpha[i % size, rows] * scaled_p[pieces]
    end = int(lengths[0])
    out[:shortest] = np.log(np.maximum(alpha[end % size, :shortest], 1e-300)) + logs[:shortest]
    return out


def expected_counts(words: list[bytes], weights: np.ndarray, pieces: Pieces, scaled_p: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in ``words`` of one length (one language)."""
    length, steps = len(words[0]), pieces.matches(words)[1]
    alpha = forward(length, steps, len(words), scaled_p)[:, :, 0]
    beta = np.zeros_like(alpha)
    beta[length] = weights / alpha[length]
    counts = np.zeros(len(scaled_p))
    column = scaled_p[:, 0]
    for i, j, rows, found in reversed(steps):
        passed = column[found] * beta[j, rows]
        np.add.at(counts, found, alpha[i, rows] * passed)
        beta[i, rows] += passed
    return counts


def stretches(word: bytes) -> Iterator[bytes]:
    word = b" " + word
    for lo in range(0, len(word), STRETCH):
        yield word[lo:lo + STRETCH]


def by_length(words: Iterable[bytes], exact: bool = True) -> Iterator[list[int]]:
    """Indexes of words of one length, a few thousand at a time; without
    ``exact``, long ones of lengths within a factor of two, the longest first."""
    groups: dict[int, list[int]] = {}
    lengths = [len(w) for w in words]
    for k, n in enumerate(lengths):
        groups.setdefault(n if exact or n <= 64 else -n.bit_length(), []).append(k)
    for group in groups.values():
        group.sort(key=lambda k: -lengths[k])
        lo = 0
        while lo < len(group):
            hi = lo + max(1, min(8192, CELLS // max(lengths[group[lo]], 1)))
            yield group[lo:hi]
            lo = hi


@lru_cache(maxsize=2)
def pieces_of(vocab: tuple[bytes, ...]) -> Pieces:
    return Pieces(list(vocab))


class Scorer:
    """Log probabilities of words under every language; one per worker and model."""

    def __init__(self, vocab: tuple[bytes, ...], probabilities: np.ndarray):
        self.pieces = pieces_of(vocab)
        self.scaled_p = scaled(probabilities, list(vocab))
        self.place: dict[int, int] = {}
        self.scores = np.zeros((REMEMBERED, probabilities.shape[1]))

    def score(self, words: list[bytes]) -> np.ndarray:
        parts, out = [b" " + w for w in words], np.zeros((len(words), self.scores.shape[1]))
        for group in by_length(parts, exact=False):
            lengths, steps = self.pieces.matches([parts[k] for k in group])
            out[group] = log_totals(lengths, steps, self.scaled_p, self.pieces.longest) - lengths[:, None] * math.log(SCALE)
        return out

    def of(self, words: Words) -> np.ndarray:
        """One row per word of the run."""
        keys, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.place) + len(keys) > REMEMBERED:
            self.place.clear()
        get = self.place.get
        at = np.array([get(k, -1) for k in keys.tolist()], np.int64)
        new = np.flatnonzero(at < 0)
        data = words.data.tobytes()
        spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist())
        fresh = self.score([data[a:b] for a, b in spans])
        if len(keys) > REMEMBERED:
            table = np.zeros((len(keys), self.scores.shape[1]))
            table[new] = fresh
            return table[inverse]
        at[new] = len(self.place) + np.arange(len(new))
        self.place.update(zip(keys[new].tolist(), at[new].tolist()))
        self.scores[at[new]] = fresh
        return self.scores[at][inverse]


_SCORERS: dict[str, Scorer] = {}


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column(1)):
            langs = batch.column(0).slice(lo, hi - lo).to_pylist()
            words = Words(batch.column(1).slice(lo, hi - lo))
            data, counts = words.data.tobytes(), {}
            for r, lang in enumerate(langs):
                for k in range(words.rows[r], words.rows[r + 1]):
                    for part in stretches(data[words.start[k]:words.end[k]]):
                        counts[lang, part] = counts.get((lang, part), 0) + 1
            keys = list(counts)
            yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                                   pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def learn(docs: DataFrame, vocab: list[bytes], sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages in order and the probabilities (pieces x languages) from
    ``docs(doc_id, text, lang)`` of which the rows may be learnt from."""
    spark = docs.sparkSession
    sizes = {r["lang"]: r["n"] for r in docs.where("lang is not null and text is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((len(vocab), 0))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = docs.where("lang is not null and text is not null").where(chance < F.get(F.array(F.try_element_at(share, F.col("lang"))), F.lit(0)))
    counted = map_arrow(chosen.select("lang", F.lower("text")), _count_words, "lang string, word binary, n bigint")
    table = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition(2 * spark.sparkContext.defaultParallelism)
    table = land(table, "language-words")
    shared_vocab = spark.sparkContext.broadcast(tuple(vocab))
    place = {lang: k for k, lang in enumerate(langs)}
    p = np.full((len(vocab), len(langs)), 1.0 / len(vocab))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(p)

        def expect(batches):
            pieces, now = pieces_of(shared_vocab.value), scaled(model.value, list(shared_vocab.value))
            total = np.zeros(now.shape)
            for batch in batches:
                owner = np.array([place[x] for x in batch.column(0).to_pylist()])
                words, weights = batch.column(1).to_pylist(), np.array(batch.column(2), float)
                for k in range(now.shape[1]):
                    own = np.flatnonzero(owner == k)
                    for group in by_length([words[i] for i in own]):
                        at = own[group]
                        total[:, k] += expected_counts([words[i] for i in at], weights[at], pieces, now[:, k:k + 1])
            piece, lang = np.nonzero(total)
            yield pa.record_batch([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        found = map_arrow(table, expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        p = np.full(p.shape, SMOOTHING)
        np.add.at(p, (found.column("piece").to_numpy(), found.column("lang").to_numpy()), found.column("n").to_numpy())
        p /= p.sum(axis=0)
        model.unpersist()
    return langs, p


def predict(docs: DataFrame, vocab: list[bytes], langs: list[str], probabilities: np.ndarray) -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``, which take the
    place of columns of their names; reads the text alone."""
    text = F.col("text")
    lettered = packed(docs, F.when(text.rlike("\\p{L}"), F.lower(text)).alias("text"), without=["text"])
    schema = row_type(docs, ["text"]) + ", lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast((f"{id(docs)}-{len(vocab)}-{probabilities.sum()!r}", tuple(vocab), probabilities))

    def run(batches):
        name, pieces, p = shared.value
        if langs and name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(pieces, p)
        for batch in batches:
            texts = batch.column(1)
            known = np.array(texts.is_valid()) & bool(langs)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for lo, hi in chunks(texts) if langs else ():
                words = Words(texts.slice(lo, hi - lo))
                sums = np.concatenate([np.zeros((1, len(langs))), np.cumsum(_SCORERS[name].of(words), axis=0)])
                total = sums[words.rows[1:]] - sums[words.rows[:-1]]
                best[lo:hi] = total.argmax(axis=1)
                score[lo:hi] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            names = [langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                                  names=["row", "lang_pred", "score"])

    return unpacked(map_arrow(lettered, run, schema), docs.drop("text"), ["lang_pred", "score"])


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs(doc_id, text, lang)`` with ``held_out``, ``lang_pred`` and ``score``;
    learns from the rows that are not held out."""
    vocab = vocabulary(path)
    langs, p = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"), vocab)
    return predict(docs.withColumn("held_out", held_out()), vocab, langs, p)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
