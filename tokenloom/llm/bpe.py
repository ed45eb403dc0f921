"""Operator 8, BPE encoding and decoding: backtracking encoder.

A text is cut by the tokenizer's special tokens and its word pattern; every
word is encoded on its own.  In a word, an Aho-Corasick automaton over the
reversed tokens gives the longest token that starts at each byte.  The
encoder takes the longest token, checks it against its left neighbour in a
pair-compatibility table, and otherwise falls back to the token's longest
proper prefix that is a token, or, if none is left, drops the neighbour and
marks the place as a dead end.  A sequence of tokens is the exact result of
the merges if and only if every two neighbours are compatible, that is, if
the merges of their joined bytes give the two back; so one pass with each
place marked at most once gives exact merges in linear time.

The compatibility table is filled as pairs occur; it and the words encoded
before are remembered per worker, ``TABLE_ENTRIES`` of each at most.
Decoding gathers all tokens' bytes through an offset table.

The vocabulary file is read on the driver and broadcast (1.5 MB; a tokenizer
file is at most ``FILE_BYTES``).  Texts never leave their task.

Null or empty text: no ids, empty decoded text.  Very long texts and words
are encoded whole.  Repeated rows and extra columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.rows import packed, row_type, unpacked
from tokenloom.llm.tables import map_arrow, read

TOKENIZER = "byte_bpe_50k.json"
FILE_BYTES = 64 << 20
TABLE_ENTRIES = 400_000
LONGEST_KEY = 64   # characters of a remembered word
# fixed value: the word pattern of byte-level BPE files whose pre-tokenizer says use_regex
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes for the characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Remembered(dict):
    """Results of ``make`` by argument; at ``TABLE_ENTRIES`` the older half goes."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) > LONGEST_KEY:
            return found
        if len(self) >= TABLE_ENTRIES // 2:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Codec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, definition: str):
        import ahocorasick
        import regex

        spec = json.loads(definition)
        model, to_byte = spec["model"], byte_of_character()
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer") \
                or spec["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges"):
            raise ValueError("expected a byte-level BPE file without normalizer and prefix space")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else (lambda t: [t])
        self.words = regex.compile(PATTERN).findall
        as_bytes = lambda t: bytes(to_byte[c] for c in t)
        raw = {as_bytes(t): i for t, i in model["vocab"].items() if t not in self.special}
        pairs = [tuple(map(as_bytes, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        made = {a + b for a, b in pairs}
        # tokens that merges can give
        self.ids = {t: i for t, i in raw.items() if len(t) == 1 or t in made}
        self.token = {i: t for t, i in self.ids.items()}
        self.prefix = {}
        automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            automaton.add_word(t[::-1].decode("latin-1"), i)
            self.prefix[i] = next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1)
        automaton.make_automaton()
        self.automaton = automaton
        size = max([*self.token, *self.special.values()]) + 1
        pieces = [self.token.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            pieces[i] = content.encode()
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.compatible = Remembered(self.fits)
        self.known = Remembered(lambda word: np.array(self.encode_word(word.encode()), "<u4").tobytes())

    def merge(self, data: bytes) -> list[bytes]:
        """Plain merging, lowest rank first; used on the bytes of two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(pair) for pair in zip(parts, parts[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                    ranks[i - 1:i] = [None]   # the right part is used up
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, pair: tuple[int, int]) -> bool:
        a, b = self.token[pair[0]], self.token[pair[1]]
        return self.merge(a + b) == [a, b]

    def encode_word(self, data: bytes) -> list[int]:
        n = len(data)
        longest = [-1] * n
        for end, token in self.automaton.iter(data[::-1].decode("latin-1")):
            start, have = n - 1 - end, longest[n - 1 - end]
            if have < 0 or len(self.token[token]) > len(self.token[have]):
                longest[start] = token
        out, dead, at = [], set(), 0
        token, size, prefix, compatible = longest[0], self.token, self.prefix, self.compatible
        while True:
            end = at + len(size[token])
            if end not in dead and (not out or compatible[out[-1], token]):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
                continue
            token = prefix[token]
            while token < 0:
                dead.add(at)
                last = out.pop()
                at -= len(size[last])
                token = prefix[last]

    def encode(self, text: str, special: bool = True) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; without ``special``, special
        tokens' strings are ordinary text."""
        out = []
        for k, part in enumerate(self.split(text) if special else [text]):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out.extend(map(self.known.__getitem__, self.words(part)))
        return b"".join(out)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        start, length = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(length)
        if not len(ends):
            return b""
        return self.blob[np.arange(ends[-1]) + np.repeat(start - (ends - length), length)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(definition: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(definition)


def definition(spark: SparkSession, path: str | None = None):
    """The tokenizer file as a broadcast string."""
    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path(TOKENIZER))
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > FILE_BYTES:
        raise ValueError(f"{path} is larger than {FILE_BYTES} bytes")
    return spark.sparkContext.broadcast(text)


def _texts(batch: pa.RecordBatch, name: str) -> Iterable[str]:
    column = batch.column(batch.schema.get_field_index(name))
    return (x.as_py() or "" for x in column)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, check: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (array of ints); with ``check`` also
    ``round_trip``, whether the ids decode to the text.  They take the place
    of columns of these names."""
    shared = definition(docs.sparkSession, path)
    results = ["n_tokens", "ids", *["round_trip"] * check]
    schema = row_type(docs, [text_col]) + ", text string, n_tokens bigint, ids array<int>" + ", round_trip boolean" * check

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = list(_texts(part, "text"))
                ids = [np.frombuffer(c.encode(t), "<i4") for t in texts]
                same = [pa.array([c.decode(i) == t for i, t in zip(ids, texts)], pa.bool_())] if check else []
                counts = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.array(np.concatenate(ids), pa.int32())
                yield pa.record_batch([part.column(0), part.column(1), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values), *same], names=["row", "text", *results])

    rows = packed(docs, F.col(text_col).alias("text"), without=[text_col])
    return unpacked(map_arrow(rows, run, schema), docs, results, {text_col: "text"})


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None, out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids (null ids: empty) in ``out_col``."""
    shared = definition(encoded.sparkSession, path)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            texts = [c.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["row", "decoded"])

    out = map_arrow(packed(encoded, F.col(ids_col).alias("ids")), run, row_type(encoded) + ", decoded string")
    return unpacked(out.withColumnRenamed("decoded", out_col), encoded, [out_col])


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: number and digest of the ids, and the
    digest of the text that they decode to."""
    shared = definition(docs.sparkSession, path)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in _texts(batch, "text"):
                ids = c.encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(np.frombuffer(ids, "<u4").astype(np.int64)).encode()).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
