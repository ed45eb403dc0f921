"""Operator 11, Merkle dataset manifest: content-addressed DAG descent.

Every row is a leaf, the sha256 of its fields.  The leaves of a source, in
the order of their ids, are hashed in runs of ``FAN`` up to one subroot; the
subroots, in the order of their sources, up to the root of the dataset.

*Records.*  Every inner node is a record ``digest -> children`` in a written
table.  Trees are built in bands of ``LEVELS`` levels: a block of
``FAN ** LEVELS`` neighbouring nodes is folded by one task, and the blocks'
tops are the nodes of the next band.  So a source of a hundred billion rows
takes three bands, and no task holds more than one block of 6,561 digests,
whatever the share of a source.

*Descent.*  A request names a leaf by its source and rank.  It starts at the
root and goes down by the digits of its rank: it looks up the record of the
digest that it stands on, goes on to the child that the digit selects, and
collects the other children.  A band's records, requests and heads (the
digests on which requests enter its blocks) meet in one shuffle, block by
block.  Requests of one block share the way above it, which is walked once.
The segments collected on the way down, reversed, are the proof.

Ranks come from a range partition by (source, id) and one small table with a
row for each source of each partition: no window over a source.

Null fields count as ``-``; a null source is a source of its own, the first;
null ids come first in their source and are never tampered with.  Empty and
long texts are hashed whole.  Rows that repeat an id stand in the order of
their leaf digests, exact copies in any order (their proofs differ, as their
ranks do).  An empty table has no root and gives no rows.  Extra columns are
neither hashed nor returned by ``op11``; ``prove`` carries the request's row
as one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.tables import forget, map_arrow, read
from tokenloom.operators.rowindex import ordered_index
from tokenloom.session import default_parallelism, land

FAN = 3
LEVELS = 8                       # of one block: 6,561 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 32                       # bytes of a digest
TOP = -1                         # number of the tree over the subroots

RECORDS = "tree bigint, block bigint, digest binary, children binary, n bigint"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row, as bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256))


def depth(n: int) -> int:
    """Levels above ``n`` nodes up to a single one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def join_digests(children: bytes) -> bytes:
    """Digest of a node: sha256 of its children's digests as hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


# --------------------------------------------------------------------------
# building
# --------------------------------------------------------------------------

def _blocks(batches: Iterable[pa.RecordBatch], size: int):
    """``(tree, block, n, digests)`` of rows sorted by tree and index."""
    key, held, n = None, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, idx, counts = (batch.column(k).to_numpy() for k in (0, 1, 3))
        block = idx // size
        cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        digests = batch.column(2).to_pylist()
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tree)]):
            at = (int(tree[lo]), int(block[lo]))
            if at != key:
                if key is not None:
                    yield *key, n, held
                key, held, n = at, [], int(counts[lo])
            held = held + digests[lo:hi]
    if key is not None:
        yield *key, n, held


def _fold(batches: Iterable[pa.RecordBatch], levels: int) -> Iterable[pa.RecordBatch]:
    """Blocks of nodes to their records and, without children, their tops."""
    names = ["tree", "block", "digest", "children", "n"]
    rows: list[tuple] = []

    def batch():
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for tree, block, n, nodes in _blocks(batches, FAN ** levels):
        for _ in range(min(levels, depth(n))):
            runs = [b"".join(nodes[k:k + FAN]) for k in range(0, len(nodes), FAN)]
            nodes = [join_digests(r) for r in runs]
            n = -(-n // FAN)
            rows += [(tree, block, d, r, n) for d, r in zip(nodes, runs)]
        rows.append((tree, block, nodes[0], None, n))
        if len(rows) >= 1 << 14:
            yield batch()
            rows = []
    if rows:
        yield batch()


def _build(nodes: DataFrame, most: int, name: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Bands of records over ``nodes`` and the tops ``(tree, digest)``.
    ``most``: the largest number of nodes of a tree."""
    bands, roots, size = [], None, FAN ** levels
    while True:
        dealt = nodes.select("tree", "idx", "digest", "n").withColumn("block", F.floor(F.col("idx") / size))
        dealt = dealt.repartition(default_parallelism(nodes.sparkSession), "tree", "block").sortWithinPartitions("tree", "idx").drop("block")
        band = land(map_arrow(dealt, lambda it: _fold(it, levels), RECORDS), f"{name}-{len(bands)}")
        bands.append(band)
        tops = band.where("children IS NULL")
        done = tops.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        if most <= size:
            return bands, roots
        nodes = tops.where("n > 1").select("tree", F.col("block").alias("idx"), "digest", "n")
        most = -(-most // size)


@dataclass
class Manifest:
    """Written tables of one dataset's tree.

    ``leaves``: ``(tree, rank, n, digest, row)`` for each row of the dataset,
    ``n`` being its source's number of rows; ``sources``: ``(tree, source, n,
    subroot)``; ``root``: hex digest, None for an empty dataset.
    """

    leaves: DataFrame
    sources: DataFrame
    bands: list[DataFrame]
    top_bands: list[DataFrame]
    n_sources: int
    root: str | None
    levels: int = LEVELS

    @property
    def records(self) -> DataFrame:
        """``(digest, children)`` as hex text, each inner node once."""
        every = self.bands[0]
        for band in [*self.bands[1:], *self.top_bands]:
            every = every.unionByName(band)
        children = F.expr(f"transform(sequence(0, length(children) div {WIDTH} - 1), "
                          f"k -> lower(hex(substring(children, {WIDTH} * k + 1, {WIDTH}))))")
        return (every.where("children IS NOT NULL").select(F.lower(F.hex("digest")).alias("digest"), children.alias("children"))
                .dropDuplicates(["digest"]))


def build(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """Manifest of ``rows(source, key, digest, row)``: the group, what orders
    its leaves, the leaf's digest, and what ``leaves`` shall carry."""
    spark = rows.sparkSession
    order = [F.col("source"), F.col("key"), F.col("digest")]
    # a scan's own numbers part exact copies, so that no key is hot
    spread = land(rows, "merkle-rows").withColumn("_scan", F.monotonically_increasing_id())
    tagged = spread.repartitionByRange(default_parallelism(spark), *order, F.col("_scan")).sortWithinPartitions(*order, F.col("_scan"))
    tagged = land(tagged.drop("_scan").withColumn("id", F.monotonically_increasing_id()).withColumn("pid", F.shiftright("id", 33)), "merkle-order")
    # one row for each source of each partition; a source has as many as there are partitions at most
    pieces = tagged.groupBy("source", "pid").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    by_source = Window.partitionBy("source")
    before = by_source.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = land(pieces.withColumns({"before": F.coalesce(F.sum("rows").over(before), F.lit(0)), "n": F.sum("rows").over(by_source),
                                      "opens": F.min("first").over(by_source)}), "merkle-pieces")
    # sources stand in the order of their first rows
    trees = ordered_index(pieces.where("first = opens").select("source", "n", "opens"), [F.col("opens")], "tree")
    trees = land(trees.select("tree", "source", "n", "opens"), "merkle-sources")
    n_sources, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = pieces.join(trees.select("tree", "opens"), "opens").select(F.col("pid").alias("_pid"), F.col("source").alias("_source"), "tree", "first", "before", "n")
    leaves = land(tagged.join(placed, (F.col("pid") == F.col("_pid")) & F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", (F.col("before") + F.col("id") - F.col("first")).alias("rank"), "n", "digest", "row"), "merkle-leaves")
    forget(tagged)
    if not n_sources:
        return Manifest(leaves, trees.select("tree", "source", "n", F.lit(None).cast("binary").alias("subroot")), [], [], 0, None)
    bands, roots = _build(leaves.withColumnRenamed("rank", "idx"), most, "merkle-band", levels)
    sources = land(trees.drop("opens").join(roots.withColumnRenamed("digest", "subroot"), "tree"), "merkle-subroots")
    top = sources.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"),
                         F.lit(n_sources).cast("bigint").alias("n"))
    top_bands, root = _build(top, n_sources, "merkle-top", levels)
    return Manifest(leaves, sources, bands, top_bands, n_sources, bytes(root.first()["digest"]).hex(), levels)


# --------------------------------------------------------------------------
# descent
# --------------------------------------------------------------------------

_HEAD, _RECORD, _REQUEST = 0, 1, 2


def _walk(batches: Iterable[pa.RecordBatch], band: int, levels: int, names: list[str]) -> Iterable[pa.RecordBatch]:
    """Rows of blocks, head and records before requests, to the requests with
    the digest that they reach and all that they passed by, lowest first."""
    size, key, head, store = FAN ** levels, None, None, {}
    for batch in batches:
        column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        tree, block, kind, idx = (column[k].to_pylist() for k in ("tree", "block", "kind", "idx"))
        digest, more, shape, n = (column[k].to_pylist() for k in ("digest", "more", "shape", "n"))
        at, ends, others, shapes, subroots, sizes = [], [], [], [], [], []
        for k in range(batch.num_rows):
            if key != (tree[k], block[k]):
                key, head, store = (tree[k], block[k]), None, {}
            if kind[k] == _HEAD:
                powers = [FAN ** k for k in range(min(levels, depth(-(-n[k] // size ** band))))][::-1]
                head = (digest[k], more[k], shape[k], n[k], column["subroot"][k].as_py(), powers)
            elif kind[k] == _RECORD:
                store[digest[k]] = more[k]
            else:
                here, above, above_shape, leaves, subroot, powers = head
                rank, passed, steps = idx[k] - block[k] * size, [], []
                for power in powers:
                    children = store[here]
                    place = rank // power % FAN
                    lo = place * WIDTH
                    here = children[lo:lo + WIDTH]
                    passed.append(children[:lo] + children[lo + WIDTH:])
                    steps.append(4 * place + len(children) // WIDTH)
                at.append(k)
                ends.append(here)
                others.append(b"".join(passed[::-1]) + above)
                shapes.append(bytes(steps[::-1]) + above_shape)
                subroots.append(subroot)
                sizes.append(leaves)
        if at:
            take = pa.array(at, pa.int64())
            yield pa.record_batch(
                [column["tree"].take(take), column["idx"].take(take), pa.array(ends, pa.binary()), pa.array(others, pa.binary()),
                 pa.array(shapes, pa.binary()), pa.array(subroots, pa.binary()), pa.array(sizes, pa.int64()), column["row"].take(take)],
                names=names)


def _descend(heads: DataFrame, records: DataFrame, requests: DataFrame, band: int, levels: int) -> DataFrame:
    """``requests(tree, idx, row)`` from ``heads(tree, block, digest, more, shape,
    subroot, n)`` through one band: ``(tree, idx, digest, more, shape, subroot, n, row)``."""
    row = requests.schema["row"].dataType.simpleString()
    none = lambda kind: F.lit(None).cast(kind)
    parts = [
        heads.select("tree", "block", F.lit(_HEAD).alias("kind"), none("bigint").alias("idx"), "digest", "more", "shape", "subroot", "n", none(row).alias("row")),
        records.where("children IS NOT NULL").select(
            "tree", "block", F.lit(_RECORD).alias("kind"), none("bigint").alias("idx"), "digest", F.col("children").alias("more"),
            none("binary").alias("shape"), none("binary").alias("subroot"), none("bigint").alias("n"), none(row).alias("row")),
        requests.select("tree", F.floor(F.col("idx") / FAN ** levels).alias("block"), F.lit(_REQUEST).alias("kind"), "idx", none("binary").alias("digest"),
                        none("binary").alias("more"), none("binary").alias("shape"), none("binary").alias("subroot"), none("bigint").alias("n"), "row")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    every = every.repartition(default_parallelism(heads.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "kind")
    names = ["tree", "idx", "digest", "more", "shape", "subroot", "n", "row"]
    schema = f"tree bigint, idx bigint, digest binary, more binary, shape binary, subroot binary, n bigint, row {row}"
    return map_arrow(every, lambda it: _walk(it, band, levels, names), schema)


def _wanted(requests: DataFrame, below: int) -> DataFrame:
    """The nodes over ``below`` leaves each that lie over ``requests(tree, idx, n)``."""
    over = requests.where(F.col("n") > below).select("tree", F.floor(F.col("idx") / below).alias("idx")).distinct()
    return over.withColumn("row", F.lit(None).cast("int"))


def _heads(found: DataFrame) -> DataFrame:
    return found.select("tree", F.col("idx").alias("block"), "digest", "more", "shape", "subroot", "n")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Proofs of ``requests(tree, rank, row)``: ``(row, leaf, subroot, siblings,
    shape)``.  ``siblings``: digests of 32 bytes, leaf to root, each level left
    to right; ``shape``: one byte a level, four times the place in its run
    plus the length of the run.  Ranks that the dataset does not hold give
    no row."""
    known = manifest.sources.select("tree", "n")
    asked = requests.join(known, "tree").where("rank >= 0 AND rank < n").select("tree", F.col("rank").alias("idx"), "n", "row")
    if manifest.root is None:
        nothing = F.lit(None).cast("binary")
        return asked.select("row", nothing.alias("leaf"), nothing.alias("subroot"), nothing.alias("siblings"), nothing.alias("shape"))
    empty = F.lit(b"")
    start = requests.sparkSession.range(1).select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("block"), F.unhex(F.lit(manifest.root)).alias("digest"),
        empty.alias("more"), empty.alias("shape"), empty.alias("subroot"), F.lit(manifest.n_sources).cast("bigint").alias("n"))
    over = asked.select(F.col("tree").alias("idx"), F.lit(TOP).cast("bigint").alias("tree"), F.lit(manifest.n_sources).alias("n")).distinct()
    levels, size = manifest.levels, FAN ** manifest.levels
    heads = start
    for band in range(len(manifest.top_bands) - 1, 0, -1):
        heads = _heads(_descend(heads, manifest.top_bands[band], _wanted(over, size ** band), band, levels))
    found = _descend(heads, manifest.top_bands[0], over.select("tree", "idx", F.lit(None).cast("int").alias("row")), 0, levels)
    entry = land(found.select(F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("block"), "digest", "more", "shape",
                              F.col("digest").alias("subroot")).join(known, "tree"), "merkle-entry")
    heads = None
    for band in range(len(manifest.bands) - 1, -1, -1):
        opens = entry.where(F.col("n") > size ** band) if band else entry
        opens = opens.where(F.col("n") <= size ** (band + 1))
        heads = opens if heads is None else heads.unionByName(opens)
        wanted = _wanted(asked, size ** band) if band else asked.select("tree", "idx", "row")
        found = _descend(heads, manifest.bands[band], wanted, band, levels)
        heads = land(_heads(found), "merkle-heads") if band else None
    return found.select("row", F.col("digest").alias("leaf"), "subroot", F.col("more").alias("siblings"), "shape")


def fold(digest: str, siblings: str = "siblings", shape: str = "shape") -> Column:
    """Root, as hex text, that the leaf in column ``digest`` has with a proof."""
    step = f"""
    aggregate(transform(sequence(1, length({shape})), k -> cast(conv(hex(substring({shape}, k, 1)), 16, 10) as int)),
      named_struct('h', lower(hex({digest})), 'at', 1L),
      (s, c) -> named_struct(
        'h', sha2(cast(concat(lower(hex(substring({siblings}, cast(s.at as int), {WIDTH} * cast(c div 4 as int)))), s.h,
                              lower(hex(substring({siblings}, cast(s.at + {WIDTH} * (c div 4) as int), {WIDTH} * cast(c % 4 - 1 - c div 4 as int))))) as binary), 256),
        'at', s.at + {WIDTH} * (c % 4 - 1)),
      s -> s.h)"""
    return F.when(F.length(shape) == 0, F.lower(F.hex(digest))).otherwise(F.expr(step))


# --------------------------------------------------------------------------
# documents
# --------------------------------------------------------------------------

def document_rows(docs: DataFrame) -> DataFrame:
    """Rows for ``build``; ``row`` is ``(doc_id, presented)``, the leaf of what a
    reader finds: where 2 divides the crc32 of the id, line feeds are lost."""
    plain = [F.col(c) for c in FIELDS]
    own = leaf(plain)
    lost = leaf([F.translate(c, "\n", "") if name == "text" else c for name, c in zip(FIELDS, plain)])
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return docs.select("source", F.col("doc_id").alias("key"), own.alias("digest"),
                       F.struct("doc_id", F.when(tampered, lost).otherwise(own).alias("presented")).alias("row"))


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Every document against the manifest of ``docs``."""
    manifest = build(document_rows(docs), levels)
    proofs = prove(manifest, manifest.leaves.select("tree", "rank", "row"))
    root = F.lit(manifest.root).cast("string")
    out = proofs.select(F.col("row.doc_id").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
                        root.alias("root"), F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
                        F.col("row.presented").alias("presented"), "siblings", "shape")
    out = out.withColumn("folded_root", fold("presented")).drop("presented", "siblings", "shape")
    return out.withColumn("verified", F.col("folded_root") == root)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))
