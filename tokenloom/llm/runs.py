"""Operator 13, periodic run detection: maximal-pair enumeration.

A run is a stretch of words with smallest period q, at least ``EXPONENT * q``
and ``SHORTEST`` words long, that no neighbouring word extends.  Its start s
and s + q are a maximal pair: the words from both on agree for ``length - q``
words and no longer, and the words before them differ.  In turn, a maximal
pair at distance d whose words agree for ``(EXPONENT - 1) * d`` or more is a
run, from the first place to the end of the agreement, as it stands; of pairs
with the same stretch, the least distance is the period.

For a run of texts at once, suffixes are sorted by doubling (each round sorts
only those not yet alone; suffixes of different texts never compare equal),
and neighbours' common prefixes come from span hashes.  Stretches of the
order in which neighbours agree on ``SHORTEST - 1`` words, and which hold two
places close enough, are walked as LCP-interval trees from the leaves up.  A
node keeps its places in order and as lists by the word to their left.  Where
two children meet under a node of depth l, the places of the smaller look for
partners of the larger within ``l // (EXPONENT - 1)`` words and of another
left word; the smaller's lists are skipped where the larger has no other left
word.  Places of one node that are so close are steps of one period.  So the
partners behind a place are the first of them at most, and those ahead of it
are all or none of them: every step either finds a pair or ends the search.

The hashes have 64 bits.  Rows never leave their task.

Null or empty text: no words, no runs.  Long texts are handled whole; memory
grows with their words.  Repeated rows are rows of their own.  Ties of the
greatest exponent: the smallest start, then the smallest period.  An empty
table gives no rows.  Extra columns pass through ``find`` and ``collapse`` as
one struct; the digests ignore them.  A null doc_id plants nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.tables import map_arrow, read
from tokenloom.llm.words import SpanHash, Words, chunks, mix, text_bytes

EXPONENT = 4      # least length of a run, in periods
SHORTEST = 6      # least length of a run, in words
_BLOCK = 1024     # places in one block of an ordered list


class Places:
    """Ordered list of places, in blocks."""

    __slots__ = ("blocks", "heads")

    def __init__(self, place: int):
        self.blocks, self.heads = [[place]], [place]

    def add(self, place: int) -> None:
        k = max(0, bisect_right(self.heads, place) - 1)
        block = self.blocks[k]
        insort(block, place)
        self.heads[k] = block[0]
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks[k:k + 1] = [block[:half], block[half:]]
            self.heads[k:k + 1] = [block[0], block[half]]

    def upward(self, low: int) -> Iterator[int]:
        """Places from ``low`` on."""
        k = max(0, bisect_right(self.heads, low) - 1)
        at = bisect_left(self.blocks[k], low)
        while k < len(self.blocks):
            block = self.blocks[k]
            while at < len(block):
                yield block[at]
                at += 1
            k, at = k + 1, 0


class Node:
    """Places below a node of the tree, in order and by their left word."""

    __slots__ = ("places", "lists", "size")

    def __init__(self, place: int, left: int):
        self.places, self.lists, self.size = Places(place), {left: [place]}, 1


def _meet(a: Node, b: Node, depth: int, exponent: int, lefts: dict, out: list) -> Node:
    """Join two children of a node; maximal pairs ``(first, second, depth)`` to ``out``."""
    if a.size < b.size:
        a, b = b, a
    near = depth // (exponent - 1)
    for left, places in b.lists.items():
        if len(a.lists) == 1 and left in a.lists:
            continue
        for x in places:
            for y in a.places.upward(x - near):       # the first behind x
                if y < x and lefts[y] != left:
                    out.append((y, x, depth))
                break
            for y in a.places.upward(x + 1):          # all ahead, or none
                if y > x + near or lefts[y] == left:
                    break
                out.append((x, y, depth))
    for left, places in b.lists.items():
        for x in places:
            a.places.add(x)
        mine = a.lists.get(left)
        if mine is None:
            a.lists[left] = places
        else:
            mine += places
    a.size += b.size
    return a


def maximal_pairs(places: list[int], agree: list[int], lefts: dict, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """Maximal pairs with ``exponent - 1`` times their distance in common, of
    one stretch of the sorted suffixes: ``agree[k]`` words are common to the
    suffixes ``k - 1`` and ``k``."""
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Node]] = []     # depths grow to the right
    for k, place in enumerate(places):
        node, depth = Node(place, lefts[place]), agree[k + 1] if k + 1 < len(places) else 0
        while stack and stack[-1][0] >= depth:
            below, other = stack.pop()
            node = _meet(other, node, below, exponent, lefts, out)
        stack.append((depth, node))
    return out


def suffix_order(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of the word numbers ``ids`` (equal only within a text);
    ``ends`` gives the end of each word's text.  Returns the places in order,
    each place's group of suffixes with four words in common (-1: alone), and
    the order's positions that have a group."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    fresh = np.ones(n, bool)
    fresh[1:] = ids[order[1:]] != ids[order[:-1]]
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = start
    alone = fresh & np.append(fresh[1:], True)
    live, step = order[~alone], 1       # sorted by rank, then place
    group = np.full(n, -1, np.int64)
    while len(live):
        ahead = live + step
        inside = ahead < ends[live]
        second = np.zeros(len(live), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        first = rank[live]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        live, first, second = live[by], first[by], second[by]
        opens = np.ones(len(live), bool)
        opens[1:] = first[1:] != first[:-1]
        fresh = opens.copy()
        fresh[1:] |= second[1:] != second[:-1]
        at = np.arange(len(live))
        base = np.maximum.accumulate(np.where(opens, at, 0))
        mine = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[live] = first + (mine - base)
        keep = ~(fresh & np.append(fresh[1:], True))
        step *= 2
        if step == 4:
            group[live[keep]] = rank[live[keep]]
        live = live[keep]
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    return places, group, np.flatnonzero(group[places] >= 0)


def common(hashes: SpanHash, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from ``a`` and ``b`` on agree, ``most`` at most."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        same = hashes.of(a, a + mid) == hashes.of(b, b + mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def find_runs(hashes: np.ndarray, bounds: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)``, in order, of each text of a run of
    texts; text ``t`` has the word hashes ``bounds[t]:bounds[t + 1]``."""
    texts, n = len(bounds) - 1, len(hashes)
    found: list[dict] = [{} for _ in range(texts)]
    if n >= shortest:
        own = np.repeat(np.arange(texts), np.diff(bounds))
        ends = bounds[own + 1]
        ids = mix(hashes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        places, group, shared = suffix_order(ids, ends)
        spans = SpanHash(ids)
        for at, (lo, hi), agree in _stretches(places, group, shared, spans, ends, exponent, shortest):
            base = int(bounds[own[at[0]]])
            lefts = {int(p): int(ids[p - 1]) if p > base else -1 for p in at}
            text = found[own[at[0]]]
            for x, y, depth in maximal_pairs(at.tolist(), agree.tolist(), lefts, exponent):
                stretch, period = (x - base, y - x + depth), y - x
                if stretch[1] >= shortest and text.get(stretch, period) >= period:
                    text[stretch] = period
    return [sorted((s, length, q) for (s, length), q in text.items()) for text in found]


def _stretches(places, group, shared, spans, ends, exponent, shortest):
    """Stretches of the order that may hold a run: places, bounds, agreements."""
    if not len(shared):
        return
    p, g = places[shared], group[places[shared]]
    agree = np.zeros(len(p), np.int64)
    pair = np.flatnonzero(g[1:] == g[:-1]) + 1
    a, b = p[pair - 1], p[pair]
    agree[pair] = common(spans, a, b, np.minimum(ends[a] - a, ends[b] - b))
    opens = agree < shortest - 1
    number = np.cumsum(opens) - 1
    starts = np.flatnonzero(opens)
    deepest = np.maximum.reduceat(agree, starts)
    by = np.lexsort((p, number))
    gap = np.full(len(p), np.iinfo(np.int64).max)
    same = number[by][1:] == number[by][:-1]
    gap[1:][same] = (p[by][1:] - p[by][:-1])[same]
    nearest = np.minimum.reduceat(gap, starts)
    wanted = nearest <= deepest // (exponent - 1)
    stops = np.append(starts[1:], len(p))
    for lo, hi in zip(starts[wanted].tolist(), stops[wanted].tolist()):
        yield p[lo:hi], (lo, hi), agree[lo:hi]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Which words stay when each run keeps its first period; None: all."""
    if not runs:
        return None
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return keep


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """For every tenth id, by its crc32, the words of a text with a periodic
    tail, as places in the text; None: the text as it is."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _texts(column: pa.Array, ids: list | None):
    """``(row, words, places, runs)`` of each text; ``places`` tells the words
    that stand in for the text's own, where ``ids`` plant any."""
    for lo, hi in chunks(column):
        part = column.slice(lo, hi - lo)
        words = Words(part)
        hashes, rows = words.hashes(), words.rows
        swaps = [planted(ids[lo + r], int(rows[r + 1] - rows[r])) if ids is not None else None for r in range(hi - lo)]
        if any(s is not None for s in swaps):
            hashes = hashes.copy()
            for r, swap in enumerate(swaps):
                if swap is not None:
                    hashes[rows[r]:rows[r + 1]] = hashes[rows[r]:rows[r + 1]][swap]
        data, offsets = text_bytes(part)
        for r, runs in enumerate(find_runs(hashes, rows)):
            yield lo + r, data[offsets[r]:offsets[r + 1]].tobytes(), swaps[r], runs


def _collapsed(text: bytes, swap: np.ndarray | None, runs: list) -> bytes:
    words = text.split()   # at the six separators of ``Words``
    if swap is None and not runs:
        return b" ".join(words)
    at = np.arange(len(words)) if swap is None else swap
    keep = kept_words(len(words), runs)
    return b" ".join([words[k] for k in (at if keep is None else at[keep]).tolist()])


def _run_array(runs: list[list[tuple]]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.array([[dict(start=s, length=n, period=q) for s, n, q in r] for r in runs], kind)


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def find(docs: DataFrame) -> DataFrame:
    """``(row, runs)``: the rows of ``docs`` as structs, and the runs of ``text``."""
    packed = _packed(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(1), _run_array([runs for *_, runs in _texts(batch.column(0), None)])], names=["row", "runs"])

    row = packed.schema["row"].dataType.simpleString()
    return map_arrow(packed, run, f"row {row}, runs array<struct<start:bigint,length:bigint,period:bigint>>")


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with one period left of every run of ``text``; a text without
    runs stays as it is, one with runs has its words joined by spaces."""
    packed = _packed(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for k, text, _, runs in _texts(batch.column(0), None):
                if runs:
                    texts[k] = _collapsed(text, None, runs).decode()
            yield pa.record_batch([pa.array(texts, pa.string()), batch.column(1)], names=["text", "row"])

    row = packed.schema["row"].dataType.simpleString()
    out = map_arrow(packed, run, f"text string, row {row}")
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


_REPORT = [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
           ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of greatest exponent; ``runs`` come by start, then period."""
    best = runs[0]
    for r in runs[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def report(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Runs of ``docs(doc_id, text)``: their number, the strongest, digests of all
    of them and of the collapsed text.  ``plant`` gives every tenth text a
    periodic tail first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for k, text, swap, runs in _texts(batch.column(1), ids if plant else None):
                listed = sorted(runs, key=lambda r: (r[0], r[2]))
                best = strongest(listed) if listed else (None, None, None)
                rows.append((ids[k], len(runs), *best, 1000 * best[1] // best[2] if listed else None,
                             hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest(),
                             hashlib.sha256(_collapsed(text, swap, runs)).hexdigest()))
            if rows:
                yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), _REPORT)], names=[name for name, _ in _REPORT])

    schema = ", ".join(f"{name} {'string' if kind == pa.string() else 'bigint'}" for name, kind in _REPORT)
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"), plant=True)
