"""Operator 12, best-fit packing: hierarchical residual packing.

Documents become token ids and an end id; those longer than a sequence are
cut into pieces of its length.  Pieces are packed whole into sequences of at
most ``capacity`` tokens, as few as it can:

1. Pieces are dealt at random into blocks of about ``BLOCK``.  Each block is
   packed by best fit, longest first: a piece goes into the fullest bin that
   has room for it.  Bins that are full but for ``SLACK`` tokens are final.
2. Underfull bins are the items of the next round.  Best fit leaves at most
   one bin of a block half empty (two would have been one), so only these can
   move; a merge of ``FAN`` blocks can use no more than ``FAN`` bins of a block
   as hosts for them.  So each block hands up its ``FAN + 1`` emptiest
   underfull bins, the others are final, and a merge packs at most
   ``FAN * (FAN + 1)`` items, by best fit again.
3. This repeats up a tree of merges until one is left.  A bin that moves
   keeps its pieces; where it went, and by how much its pieces shift, is a
   small table per round, and the tables are chained at the end.

Only lengths and ids of pieces are shuffled, never tokens.  A block is dealt
by a row number, so neither a hot id nor a hot length makes a large block.

Tokens are those of the tokenizers library.  Its pre-tokenizer never joins
what white space separates, so a text's ids are those of its words; each
task encodes the distinct words of a run of texts (by 64-bit hashes) and
remembers up to ``WORDS`` of them.

Null and empty text: the end id alone.  Long texts are encoded in stretches
cut at white space, whole in effect.  Repeated rows and ties are packed as
documents of their own.  An empty table gives no rows.  Extra columns are not
used; ``pieces`` returns only what it makes.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from functools import lru_cache
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.bpe import Remembered, byte_of_character
from tokenloom.llm.tables import map_arrow, read
from tokenloom.llm.words import SEPARATOR, Words, chunks, text_bytes
from tokenloom.session import default_parallelism, land

TOKENIZER = "word_bpe_49k.json"
FILE_BYTES = 64 << 20
CAPACITY = 4096
END = 1
BLOCK = 8192          # pieces of one block, on average
FAN = 16              # blocks of one merge
SLACK = 8             # tokens that a final bin may lack
WORDS = 1_000_000     # words that a worker remembers
STRETCH = 1 << 20     # bytes of a text that are encoded at once
_BITS = 21            # of a bin's number within its block
# fixed value: the split pattern of the tokenizer file
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# letters with punctuation around them: no apostrophe before letters, no "<",
# with which special tokens begin, and letters whose lower case is one letter
PLAIN = r"([!-&(-/:;=-@\[-`{-~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:;=-@\[-`{-~]*)"


# --------------------------------------------------------------------------
# tokens
# --------------------------------------------------------------------------

class WordStore:
    """Ids of words by the words' hashes, in sorted arrays of about 30 bytes a
    word.  At ``WORDS`` words the older half goes."""

    def __init__(self):
        self.older = self.fresh = self.empty()

    @staticmethod
    def empty() -> tuple[np.ndarray, ...]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def look(part: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each of ``keys`` is in ``part``, and whether it is there."""
        if not len(part[0]):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(part[0], keys), len(part[0]) - 1)
        return at, part[0][at] == keys

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """``keys`` are sorted and new to the fresh part."""
        if len(self.fresh[0]) + len(keys) > WORDS // 2:
            self.older, self.fresh = self.fresh, self.empty()
        have, begin, count, flat = self.fresh
        where = np.searchsorted(have, keys)
        begins = len(flat) + np.cumsum(counts) - counts
        self.fresh = np.insert(have, where, keys), np.insert(begin, where, begins), np.insert(count, where, counts), np.concatenate([flat, ids])


class WordEncoder:
    """Ids of texts, word by word, from a tokenizer file of the library.

    Words of Latin-1 letters with punctuation around them are split here the
    way the file's normalizer and pre-tokenizer do, and only their parts go
    through the library's model; all other words go through the library whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = re.compile(PLAIN).fullmatch if follows(json.loads(definition)) else lambda word: None
        letters, tokenize = {b: c for c, b in byte_of_character().items()}, self.tokenizer.model.tokenize
        self.parts = Remembered(lambda part: array("I", [t.id for t in tokenize(part.encode().decode("latin-1").translate(letters))]).tobytes())
        self.store = WordStore()

    def word(self, word: str) -> bytes | None:
        """Ids of a plain word; None for others."""
        match = self.plain(word)
        if match is None:
            return None
        before, stem, after = match.groups()
        ids = self.parts[stem.lower()]
        if before:
            ids = self.parts[before] + ids
        return ids + self.parts[after] if after else ids

    def encode(self, words: list[str]) -> list[bytes]:
        out = [self.word(w) for w in words]
        others = [k for k, ids in enumerate(out) if ids is None]
        if others:
            encoded = self.tokenizer.encode_batch([words[k] for k in others], add_special_tokens=False)
            for k, e in zip(others, encoded):
                out[k] = array("I", e.ids).tobytes()
        return out

    def run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts, and where each text's ids end."""
        words = Words(texts)
        if not len(words.start):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        keys, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        _, known = self.store.look(self.store.fresh, keys)
        new, old = np.flatnonzero(~known), self.store.older
        at, held = self.store.look(old, keys[new])
        begins, counts, data = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), words.data.tobytes()
        begins[held], counts[held] = old[1][at[held]], old[2][at[held]]
        unseen = new[~held]
        fresh = self.encode([data[a:b].decode(errors="replace") for a, b in zip(words.start[first[unseen]].tolist(), words.end[first[unseen]].tolist())])
        counts[~held] = [len(x) // 4 for x in fresh]
        begins[~held] = len(old[3]) + np.cumsum(counts[~held]) - counts[~held]
        pool = np.concatenate([old[3], np.frombuffer(b"".join(fresh), "<u4")])
        self.store.add(keys[new], counts, gather(pool, begins, counts))
        at, known = self.store.look(self.store.fresh, keys)
        if not known.all():   # the older half has just gone
            before, there = self.store.look(self.store.older, keys)
            begin = np.where(known, self.store.fresh[1][at], len(self.store.fresh[3]) + self.store.older[1][before])
            count = np.where(known, self.store.fresh[2][at], self.store.older[2][before])
            flat = np.concatenate([self.store.fresh[3], self.store.older[3]])
        else:
            begin, count, flat = self.store.fresh[1][at], self.store.fresh[2][at], self.store.fresh[3]
        ids = gather(flat, begin[which], count[which])
        return ids, np.concatenate([[0], np.cumsum(count[which])])[words.rows[1:]]

    def texts(self, column: pa.Array):
        """The ids of each text of a batch, in order."""
        for lo, hi in chunks(column):
            part = column.slice(lo, hi - lo)
            data, offsets = text_bytes(part)
            if hi - lo == 1 and len(data) > 2 * STRETCH:
                yield np.concatenate([self.run(pa.array([s.tobytes()]).cast(pa.string()))[0] for s in stretches(data)])
                continue
            ids, ends = self.run(part)
            yield from np.split(ids, ends[:-1])


def gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches ``begin`` to ``begin + count`` of ``flat``, one after another."""
    ends = np.cumsum(count)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(begin - (ends - count), count)]


def follows(spec: dict) -> bool:
    """Whether a file's word rules are those that ``PLAIN`` words follow."""
    normalizer, splitter = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    return ([n["type"] for n in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in splitter.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and splitter["pretokenizers"][0]["pattern"] == {"Regex": SPLIT} and spec["model"]["type"] == "BPE"
            and all(t["content"].startswith("<") for t in spec["added_tokens"]))


def stretches(data: np.ndarray, limit: int = STRETCH):
    """``data`` in parts of about ``limit`` bytes that end before white space."""
    gaps = np.flatnonzero(SEPARATOR[data])
    lo = 0
    while lo < len(data):
        k = np.searchsorted(gaps, lo + limit)
        hi = int(gaps[k]) if k < len(gaps) else len(data)
        yield data[lo:hi]
        lo = hi


@lru_cache(maxsize=2)
def encoder(definition: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(definition)


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


PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` as pieces of at most ``capacity`` tokens:
    ``(doc_id, piece, start, length, ids_crc32)``, and ``ids`` if asked for."""
    shared = definition(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known = encoder(shared.value)
        for batch in batches:
            rows, parts = [], []
            for k, ids in enumerate(known.texts(batch.column(1))):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for number, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append((k, number, at, len(part), zlib.crc32(part.tobytes())))
                    if with_ids:
                        parts.append(part.astype(np.int32))
            if not rows:
                continue
            of, number, start, length, crc = (np.array(c, np.int64) for c in zip(*rows))
            columns = [batch.column(0).take(pa.array(of)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), pa.int32())))
            yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return map_arrow(docs.select("doc_id", "text"), run, PIECE + ", ids array<int>" * with_ids)


# --------------------------------------------------------------------------
# packing
# --------------------------------------------------------------------------

def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each of ``sizes`` (in the order given), and the bins'
    fills.  The open bins' room is a bit set, so the fullest bin with enough
    room is its lowest bit from the size on."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, offsets, fills = 0, [], [], []
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins.append(bin_)
        offsets.append(fills[bin_])
        fills[bin_] += size
        if room > size:
            by_room[room - size].append(bin_)
            rooms |= 1 << room - size
    return bins, offsets, fills


def _groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterable[pa.RecordBatch]:
    """The rows of each value of ``key``, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(key)).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[0].column(held[0].schema.get_field_index(key))[0].as_py() != values[lo]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _handed_up(fills: np.ndarray, capacity: int, slack: int, fan: int) -> np.ndarray:
    """The emptiest underfull bins."""
    order = np.argsort(fills, kind="stable")[:fan + 1]
    return order[fills[order] < capacity - slack]


def _pack_block(batches: Iterable[pa.RecordBatch], capacity: int, slack: int, fan: int) -> Iterable[pa.RecordBatch]:
    """Blocks of pieces to ``(block, bin, at, fill, piece)``: the pieces' places,
    and without a piece the bins that are handed up."""
    for block in _groups(batches, "block"):
        number = block.column(block.schema.get_field_index("block"))[0].as_py()
        item = block.column(block.schema.get_field_index("item"))
        bins, offsets, fills = best_fit(item.field("length").to_pylist(), capacity)
        up, fills = _handed_up(np.array(fills), capacity, slack, fan), np.array(fills)
        names = (number << _BITS) + np.concatenate([np.array(bins, np.int64), up])
        n, m = len(bins), len(up)
        yield pa.record_batch(
            [pa.array(np.full(n + m, number)), pa.array(names), pa.concat_arrays([pa.array(offsets, pa.int64()), pa.nulls(m, pa.int64())]),
             pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(fills[up].astype(np.int64))]), pa.concat_arrays([item, pa.nulls(m, item.type)])],
            names=["block", "bin", "at", "fill", "item"])


def _merge(batches: Iterable[pa.RecordBatch], capacity: int, slack: int, fan: int) -> Iterable[pa.RecordBatch]:
    """Groups of bins to ``(block, bin, host, shift, fill)``: a bin that moves and
    where to, or (without a host) a bin that is handed up."""
    for group in _groups(batches, "group"):
        column = {name: group.column(k) for k, name in enumerate(group.schema.names)}
        names, sizes = column["bin"].to_numpy(), column["fill"].to_pylist()
        bins, offsets, fills = best_fit(sizes, capacity)
        hosts = {}
        for k, b in enumerate(bins):
            hosts.setdefault(b, int(names[k]))   # the first of a bin stays where it is
        moved = [k for k, at in enumerate(offsets) if at]
        up = _handed_up(np.array(fills), capacity, slack, fan).tolist()
        number = column["group"][0].as_py()
        yield pa.record_batch(
            [pa.array([number] * (len(moved) + len(up)), pa.int64()),
             pa.array([int(names[k]) for k in moved] + [hosts[b] for b in up], pa.int64()),
             pa.array([hosts[bins[k]] for k in moved] + [None] * len(up), pa.int64()),
             pa.array([offsets[k] for k in moved] + [None] * len(up), pa.int64()),
             pa.array([None] * len(moved) + [fills[b] for b in up], pa.int64())],
            names=["block", "bin", "host", "shift", "fill"])


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """``items`` (a written table with ``length``, 1 to ``capacity``) with
    ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    kind = items.schema.simpleString()
    n_blocks = max(1, -(-items.count() // block))
    dealt = items.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)).alias("block"), F.struct("*").alias("item"))
    dealt = dealt.repartition(default_parallelism(spark), "block").sortWithinPartitions("block", F.col("item.length").desc())
    schema = f"block bigint, bin bigint, at bigint, fill bigint, item {kind}"
    placed = land(map_arrow(dealt, lambda it: _pack_block(it, capacity, slack, fan), schema), "packed")
    up, moves = placed.where("fill IS NOT NULL").select("block", "bin", "fill"), []
    while n_blocks > 1:
        n_blocks = -(-n_blocks // fan)
        grouped = up.select(F.floor(F.col("block") / fan).alias("group"), "bin", "fill")
        grouped = grouped.repartition(default_parallelism(spark), "group").sortWithinPartitions("group", F.col("fill").desc(), "bin")
        merged = land(map_arrow(grouped, lambda it: _merge(it, capacity, slack, fan), "block bigint, bin bigint, host bigint, shift bigint, fill bigint"), "merged")
        moves.append(merged.where("host IS NOT NULL").select("bin", "host", "shift"))
        up = merged.where("host IS NULL").select("block", "bin", "fill")
    rows = placed.where("fill IS NULL")
    if not moves:
        return rows.select("item.*", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    last = moves[-1]
    for earlier in reversed(moves[:-1]):
        on = earlier.join(last.toDF("_bin", "_host", "_shift"), F.col("host") == F.col("_bin"), "left")
        chained = on.select("bin", F.coalesce("_host", "host").alias("host"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift"))
        last = chained.unionByName(last)
    out = rows.join(last.toDF("_bin", "_host", "_shift"), F.col("bin") == F.col("_bin"), "left")
    return out.select("item.*", F.coalesce("_host", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("_shift", F.lit(0))).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ids)`` of packed pieces with ``ids``; a sequence
    has at most as many pieces as tokens."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False, **options) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` with their places."""
    return pack(land(pieces(docs, path, capacity, end, with_ids), "pieces"), capacity, **options)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
