"""Operator 10, n-gram Jaccard join: size-aware heavy-light join.

Documents are sets of distinct 4-word shingles (64-bit hashes).  Equal sets
are one node, named by its smallest doc_id.  Two nodes link when
``100 * common >= 85 * united``.  Candidates come from two exact schemes; the
size at which one gives way to the other is chosen by cost from the counts of
set sizes.

*Small sets* enumerate fixed-size subsets: sets of n and m shingles that link
share ``o(n, m) = ceil(85 (n + m) / 185)``, so both list all their subsets of
that size, and equal subsets meet.

*Large sets* scan inverted lists: with shingles in the order of their hashes,
sets that link share one of the first ``p = n - ceil(0.85 n) + 1``.  Sets near
the boundary do both.

Inverted lists of up to ``LIGHT`` sets are joined with themselves.  A longer
list (a passage that many documents share, a large group of near copies) is
heavy and never joined with itself as a whole:

* A heavy shingle is moved to the end of the order, for all documents alike:
  the document takes the next light shingles into its prefix instead.  Every
  document lists ``SLACK`` more shingles than ``p`` for that.
* Where more are missing (``short`` documents, mostly members of large groups)
  each heavy list is dealt into random cells of about ``LIGHT`` sets, which are
  joined with themselves, a few times over; linked members become one group.
  Then only pairs of different groups of which one is short are left, and each
  is made once, at the first heavy shingle that its sets share.

Candidates are dropped only by proofs: by size, by position in the order, and
by a parity sketch of about as many bits as the set has shingles (each shingle
that is in one set alone flips one bit, so more flipped bits than a link
allows rule it out).  The rest is compared on whole sets.  So no link between different components is missed.

Null or empty text: the empty set; links with nothing.  Repeated rows: equal
sets, one node.  Null doc_id: takes the component of the documents with an
equal set, null if none has an id.  Extra columns are ignored by
``near_components`` and kept by ``one_of_each``.  Empty table: empty result.
"""

from __future__ import annotations

import math
from itertools import combinations
from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.rows import packed, unpacked
from tokenloom.llm.tables import components, few, forget, map_arrow, read, runtime_filters
from tokenloom.llm.words import SpanHash, Words, chunks, mix
from tokenloom.session import land

SHINGLE = 4
PERCENT = 85
LIGHT = 16        # longest list that is joined with itself
SLACK = 0.07      # of a set's size, listed beyond the prefix
SMALL_MOST = 30   # largest set size that the cost rule may call small
SCAN_COST = 8.0   # cost of one list entry, in subsets
CELL_ROUNDS = 2    # later ones find next to nothing
SETS_PER_TASK = 2_000  # texts whose sets one task makes or compares
SKETCH_LEAST = 256  # bits
BRIEF = ["s0", "s1", "s2", "s3"]  # the sketch folded to 256 bits


def overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Least number of common elements with which sets of n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, most: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that a set of n lists for its small partners."""
    found = set()
    for m in range(-(-percent * n // 100), min(most, 100 * n // percent) + 1):
        o = overlap(n, m, percent)
        if 0 < o <= min(n, m) and not (m == n == o):   # equal sets are one node already
            found.add(o)
    return sorted(found)


def straddles(n: int, most: int, percent: int = PERCENT) -> bool:
    """A small set that may link with a large one."""
    return n <= most < 100 * n // percent


def choose_boundary(counts: dict[int, int], percent: int = PERCENT) -> int:
    """The size up to which sets enumerate subsets, of least total cost."""
    def cost(most: int) -> float:
        subsets = sum(c * sum(math.comb(n, k) for k in subset_sizes(n, most, percent)) for n, c in counts.items() if n <= most)
        lists = sum(c * prefix(n, percent) * SCAN_COST for n, c in counts.items() if n > most or straddles(n, most, percent))
        return subsets + lists
    return min(range(0, SMALL_MOST + 1), key=cost)


def shingle_sets(words: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a run."""
    hashes = words.hashes(fold=True)
    spans = SpanHash(hashes)
    at = np.arange(max(0, len(hashes) - width + 1))
    grams = spans.of(at, at + width)
    out = []
    for lo, hi in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(grams[lo:hi - width + 1]))
        elif hi > lo:
            out.append(spans.of(np.array([lo]), np.array([hi])))
        else:
            out.append(grams[:0])
    return out


def parity_sketch(shingles: np.ndarray) -> bytes:
    """One bit per shingle modulo a power of two: parities of the counts."""
    bits = max(SKETCH_LEAST, 1 << (max(len(shingles), 1).bit_length() - 1))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def brief_sketch(shingles: np.ndarray) -> np.ndarray:
    """The sketch folded to its least length, as four words."""
    counts = np.bincount((shingles & np.uint64(SKETCH_LEAST - 1)).astype(np.int64), minlength=SKETCH_LEAST)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def apart(x: bytes, y: bytes) -> int:
    """At least so many elements are in one of two sets alone.  The longer
    sketch is folded to the length of the shorter."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def _describe(batches: Iterable[pa.RecordBatch], percent: int, width: int) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column(1)):
            sets = shingle_sets(Words(batch.column(1).slice(lo, hi - lo)), width)
            sizes = np.array([len(s) for s in sets], np.int64)
            marks = np.zeros((len(sets), 2), np.uint64)
            listed = []
            for i, s in enumerate(sets):
                n = len(s)
                if n:
                    marks[i] = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                listed.append(s if n <= SMALL_MOST else s[:min(n, prefix(n, percent) + math.ceil(SLACK * n) + 4)])
            flat = np.concatenate(listed) if listed else np.zeros(0, np.uint64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in listed])]).astype(np.int32)
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo), pa.array(sizes)] + [pa.array(marks[:, k].copy().view(np.int64)) for k in range(2)]
                + [pa.array(k) for k in np.array([brief_sketch(x) for x in sets]).T]
                + [pa.array([parity_sketch(x) for x in sets], pa.binary()),
                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                names=["doc_id", "n", "f0", "f1", *BRIEF, "sketch", "listed"])


def _subsets(batches: Iterable[pa.RecordBatch], most: int, percent: int) -> Iterable[pa.RecordBatch]:
    """All subsets of the sizes that matter, as the sums of what is left out."""
    for batch in batches:
        keys, nodes, meta = [], [], []
        for node, n, listed in zip(*(batch.column(k).to_pylist() for k in ("node", "n", "listed"))):
            parts = mix(np.array(listed, np.int64).view(np.uint64))
            whole = parts.sum(dtype=np.uint64)
            for size in subset_sizes(n, most, percent):
                without = np.array(list(combinations(range(n), n - size)), np.int64).reshape(math.comb(n, size), n - size)
                sums = whole - parts[without].sum(axis=1, dtype=np.uint64)
                keys.append(mix(sums + np.uint64(size * 0x632BE59BD9B4E019 % (1 << 64))))
                nodes.append(np.full(len(sums), node))
                meta.append(np.full(len(sums), n << 32))
        if keys:
            yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes).astype(np.int64)),
                                   pa.array(np.concatenate(meta).astype(np.int64))], names=["key", "node", "meta"])


def _p(n: Column, percent: int) -> Column:
    return (n - F.ceil(n * percent / 100) + 1).cast("int")


def _entries(nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """``(key, node, meta, whole)``: list entries and subsets; ``meta`` holds the
    set's size and the shingle's rank, ``whole`` tells subsets."""
    small_list = [n for n in range(1, boundary + 1) if straddles(n, boundary, percent)]
    lists = nodes.where((F.col("n") > boundary) | F.col("n").isin(small_list))
    length = F.least(F.col("n"), _p(F.col("n"), percent) + F.ceil(F.col("n") * SLACK) + 4).cast("int")
    lists = lists.select("node", "n", F.posexplode(F.slice("listed", F.lit(1), length)).alias("rank", "key"))
    lists = lists.select("key", "node", (F.shiftleft(F.col("n"), 32) + F.col("rank")).alias("meta"), F.lit(False).alias("whole"))
    if not boundary:
        return lists
    few = nodes.where((F.col("n") <= boundary) & (F.col("n") > 1)).select("node", "n", "listed")
    subsets = map_arrow(few, lambda it: _subsets(it, boundary, percent), "key bigint, node bigint, meta bigint")
    return lists.unionByName(subsets.withColumn("whole", F.lit(True)))


def _size(meta: str) -> Column:
    return F.shiftright(F.col(meta), 32)


def _rank(meta: str) -> Column:
    return F.col(meta).bitwiseAND(F.lit(0xFFFFFFFF))


def _possible(percent: int) -> Column:
    """By size and position: entries ``l`` and ``r`` of one key may link."""
    n, m, i, j = _size("l.meta"), _size("r.meta"), _rank("l.meta"), _rank("r.meta")
    most = F.when(F.col("l.whole") | F.col("r.whole"), F.least(n, m)).otherwise(
        F.least(i, j) + F.least(n - i, m - j))
    return (100 + percent) * most >= percent * (n + m)


def _pairs(left: DataFrame, right: DataFrame, also: Column, percent: int, last: Column | None = None) -> DataFrame:
    """Distinct pairs of nodes with a common key, and their groups; conditions in
    the order of their cost."""
    on = (F.col("l.key") == F.col("r.key")) & also & _possible(percent)
    joined = left.alias("l").join(right.alias("r"), on if last is None else on & last)
    swap = F.col("l.node") > F.col("r.node")
    of = lambda name, first: F.when(swap if first else ~swap, F.col(f"r.{name}")).otherwise(F.col(f"l.{name}"))
    return joined.select(of("node", True).alias("a"), of("node", False).alias("b"), of("group", True).alias("ga"), of("group", False).alias("gb")).distinct()


def _sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column("text")):
            sets = shingle_sets(Words(batch.column("text").slice(lo, hi - lo)), width)
            yield pa.record_batch([batch.column("node").slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])


PAIR = ["a", "b", "ga", "gb"]
PAIRS = "a bigint, b bigint, ga bigint, gb bigint"


def _compare(batches: Iterable[pa.RecordBatch], percent: int) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            linked.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(PAIR).filter(pa.array(linked, pa.bool_()))


def _may_link(batches: Iterable[pa.RecordBatch], percent: int) -> Iterable[pa.RecordBatch]:
    """By sketch: |A ^ B| = |A| + |B| - 2 common, and a link has
    ``(100 + percent) * common >= percent * (|A| + |B|)``."""
    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in ("na", "nb", "sa", "sb"))
        may = [(100 + percent) * (n + m - apart(x, y)) >= 2 * percent * (n + m) for n, m, x, y in zip(*columns)]
        yield batch.select(PAIR).filter(pa.array(may, pa.bool_()))


def _verified(docs: DataFrame, facts: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of the landed ``pairs`` that link; landed.  ``pairs`` is deleted."""
    n, known = pairs.count(), facts.count()
    facts = facts.select("node", "n", "sketch")
    both = pairs.join(facts.toDF("a", "na", "sa"), "a").join(facts.toDF("b", "nb", "sb"), "b")
    # a task reads its share of the sketches too, some four rows' worth each
    left = land(few(map_arrow(both, lambda it: _may_link(it, percent), PAIRS), n + 4 * known), "candidates")
    forget(pairs)
    n = left.count()
    ids = land(few(left.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 2 * n), "candidate-nodes")
    with runtime_filters(docs.sparkSession):
        texts = docs.join(ids.where("node is not null"), F.col("doc_id") == F.col("node")).select("node", "text")
        # rows that repeat an id give one set; the join has them in one place already
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))
        sets = land(map_arrow(texts.coalesce(max(1, -(-2 * n // SETS_PER_TASK))), lambda it: _sets(it, width), "node bigint, shingles binary"), "sets")
    joined = left.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    out = land(few(map_arrow(joined.coalesce(max(1, -(-n // SETS_PER_TASK))), lambda it: _compare(it, percent), PAIRS), n), "links")
    for t in (left, ids, sets):
        forget(t)
    return out


def _heavy_prefix(found: DataFrame, percent: int) -> DataFrame:
    """``(node, reach, short)`` of nodes with heavy shingles: ``reach`` ranks hold
    the prefix of light shingles; ``short`` if that is more than are listed."""
    heavy = found.where((F.col("count") > LIGHT) & ~F.col("whole")).groupBy("node").agg(
        F.max(_size("meta")).cast("int").alias("n"), F.sort_array(F.collect_list(_rank("meta").cast("int"))).alias("ranks"))
    p = _p(F.col("n"), percent)
    heavy = heavy.withColumn("p", p)
    reach = F.expr("p + aggregate(ranks, 0, (t, r) -> CASE WHEN r < p + t THEN t + 1 ELSE t END)")
    length = F.least(F.col("n"), F.col("p") + F.ceil(F.col("n") * SLACK) + 4)
    return heavy.select("node", reach.alias("reach"), (reach > length).alias("short"))


def links(docs: DataFrame, nodes: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """Links ``(a, b)`` that connect all that linked nodes connect.

    ``nodes``: landed ``(node, n, sketch, listed)``; deleted.  Links inside a group that
    is connected already may be left out; none between two groups is.
    """
    counts = {r["n"]: r["c"] for r in nodes.where(F.col("n") <= SMALL_MOST).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    boundary = choose_boundary(counts, percent)
    facts = land(nodes.select("node", "n", *BRIEF, "sketch"), "facts")
    entries = _entries(nodes, boundary, percent)
    # a node has a key once, so a key that is there twice is in two nodes
    shared = land(entries.groupBy("key").agg(F.count(F.lit(1)).alias("count")).where("count > 1"), "shared-keys")
    found = land(entries.join(shared, "key"), "shared-entries")
    forget(shared)
    forget(nodes)
    n, rank = _size("meta"), _rank("meta")
    reach = land(_heavy_prefix(found, percent), "reach")
    marked = land(found.join(reach, "node", "left").select(
        "key", "node", "meta", "whole", "count", F.coalesce("reach", _p(n, percent)).alias("reach"),
        (F.coalesce("short", F.lit(False)) | F.col("whole")).alias("short")), "marked-entries")
    forget(found)
    forget(reach)
    marked = marked.withColumn("group", F.col("node"))
    light = marked.where((F.col("count") <= LIGHT) & (F.col("whole") | (rank < F.col("reach"))))
    heavy = land(marked.where((F.col("count") > LIGHT) & (F.col("whole") | (rank < _p(n, percent)))), "heavy-entries")
    pairs = _pairs(light, light, F.col("l.node") < F.col("r.node"), percent)
    known = _verified(docs, facts, land(pairs, "light-pairs"), percent, width)
    forget(marked)
    return _resolve_heavy(docs, facts, heavy, known, percent, width)


def _near(percent: int) -> Column:
    """By the brief sketches: entries ``l`` and ``r`` may link."""
    flipped = [F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) for c in BRIEF]
    united = _size("l.meta") + _size("r.meta")
    return (100 + percent) * (united - (flipped[0] + flipped[1] + flipped[2] + flipped[3])) >= 2 * percent * united


def _apart(entries: DataFrame) -> DataFrame:
    """Entries of the lists that hold several groups and a short document; a
    list without one is settled by its members' light shingles."""
    keys = entries.groupBy("key").agg(F.min("group").alias("g"), F.max("group").alias("h"), F.max("short").alias("open"))
    return entries.join(keys.where("open AND g < h").select("key"), "key")


def _grouped(entries: DataFrame, names: DataFrame, by: str) -> DataFrame:
    """``entries`` with the group that ``names(id, component)`` gives to ``by``."""
    joined = entries.join(names.toDF("_id", "_component"), F.col(by) == F.col("_id"), "left")
    return joined.withColumn("group", F.coalesce("_component", "group")).drop("_id", "_component")


def _resolve_heavy(docs: DataFrame, facts: DataFrame, heavy: DataFrame, known: DataFrame, percent: int, width: int) -> DataFrame:
    """``known`` and the links of the heavy lists that join groups which it
    leaves apart.  Groups are found once; each turn only joins groups."""
    if heavy.where("short").isEmpty():
        return known.select("a", "b")
    unlike = F.col("l.group") != F.col("r.group")
    opens = land(heavy.groupBy("key").agg(F.max("short").alias("open")).where("open").select("key"), "open-keys")
    heavy = heavy.join(opens, "key")
    rest = _apart(_grouped(heavy, components(known), "node")).join(facts.select("node", *BRIEF), "node")
    rest, found = land(rest, "apart-entries"), [known]
    for turn in range(CELL_ROUNDS):
        cells = rest.withColumn("cell", F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("count") / LIGHT)))
        also = (F.col("l.cell") == F.col("r.cell")) & (F.col("l.node") < F.col("r.node")) & unlike & _near(percent)
        found.append(_verified(docs, facts, land(_pairs(cells, cells, also, percent), "cell-pairs"), percent, width))
        if found[-1].isEmpty():
            break
        names = components(found[-1].select(F.col("ga").alias("a"), F.col("gb").alias("b")))
        before, rest = rest, land(_apart(_grouped(rest, names, "group")), "apart-entries")
        forget(before)
        if rest.isEmpty():
            break
    if not rest.isEmpty():
        heads = rest.groupBy("node").agg(F.collect_list("key").alias("heads"))
        # a pair is made at the least heavy shingle that both list, so an entry
        # carries its document's lesser ones only
        lesser = F.expr("filter(heads, h -> h < key)")
        rest = land(rest.drop("count", "reach").join(heads, "node").withColumn("heads", lesser), "rest-entries")
        once = ~F.arrays_overlap("l.heads", "r.heads")
        also = unlike & (~F.col("r.short") | (F.col("l.node") < F.col("r.node"))) & _near(percent)
        pairs = land(_pairs(rest.where("short"), rest, also, percent, once), "rest-pairs")
        found.append(_verified(docs, facts, pairs, percent, width))
    out = known
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select("a", "b")


def near_components(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    schema = "doc_id bigint, n bigint, f0 bigint, f1 bigint, " + "".join(f"{s} bigint, " for s in BRIEF) + "sketch binary, listed array<bigint>"
    described = land(map_arrow(docs, lambda it: _describe(it, percent, width), schema), "described")
    members = land(described.select("doc_id", "n", "f0", "f1"), "members")
    nodes = land(described.where("n > 0").groupBy("f0", "f1", "n").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in (*BRIEF, "sketch", "listed")]), "nodes")
    forget(described)
    names = land(nodes.select("f0", "f1", "n", "node"), "names")
    group = components(links(docs.where("doc_id is not null"), nodes.where("node is not null"), percent, width))
    named = names.join(group.toDF("node", "group"), "node", "left").select("f0", "f1", "n", F.coalesce("group", "node").alias("component"))
    out = members.join(land(named, "named"), ["f0", "f1", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """``docs`` with one row per group: that of the smallest doc_id.  Of rows that
    repeat an id, the one with the least hash stays.  Rows without a doc_id
    stay.  Columns of any names pass through."""
    keep = near_components(docs, percent, width).where("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    named = packed(docs, F.col("doc_id").alias("_id")).join(keep, F.col("_id") == F.col("_keep"))
    # the join has rows of one id in one place already
    once = named.groupBy("_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return unpacked(once, docs).unionByName(docs.where("doc_id is null"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read(spark, sf_dir, "documents"))
