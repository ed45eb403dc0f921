"""Fixed-size training blocks.

Packing (B1) works per batch of ``batch_rows`` consecutive records of one
split: every record gets an EOS element, the batch is seen as one stream,
the stream is cut into ``block_size`` pieces and the remainder is dropped;
a batch shorter than one block yields one short block.

Plan: the token arrays are shuffled once.  A first job looks at the records'
keys (and lengths) only.  It numbers the records of a split and finds the
order values at which *parts* of a split begin, a few thousand consecutive
records each, always a whole number of batches.  These borders, at most
``MAX_PARTS`` numbers a split, go into the plan as an array constant; a binary
search in it gives each record its part.  The records are then hashed by
``(split, part)``, and everything else happens where they are: the rank in the
part gives the batch, a running sum in the batch gives the place, the record
is cut at the block borders, and the pieces are put together by
``(split, part, batch, block)``, which that partitioning serves.

With ``batch_rows=None`` a split is one batch and blocks may lie across part
borders.  The first job also gives the number of elements before each part;
the first and last block of a part are the only ones that may have pieces
elsewhere, so only those two of each part are shuffled again.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.constants import (DEFAULT_BATCH_ROWS, DEFAULT_BUCKET_ROWS, EOS_ID, IGNORE_LABEL,
                                 MASKED_ATTENTION)
from tokenloom.functions.arrays import append_value, left_pad
from tokenloom.session import default_parallelism

TOKEN_COLS = ("input_ids", "attention_mask", "labels")
FILL = {"input_ids": EOS_ID, "attention_mask": MASKED_ATTENTION, "labels": IGNORE_LABEL}


def _present(df: DataFrame, cols: Sequence[str] = TOKEN_COLS) -> list[str]:
    out = [c for c in cols if c in df.columns]
    if "input_ids" not in out:
        raise ValueError("input_ids column is required")
    return out


def _field(name: str):
    return lambda s: s[name]


#: Parts of one split: at most ``MAX_PARTS``, of ``PART_ROWS`` records where there are
#: enough for ``PARTS_PER_CORE`` parts a core, else smaller.
MAX_PARTS, PART_ROWS, PARTS_PER_CORE = 100_000, 4096, 16


@dataclass
class Borders:
    """Where the parts of one split begin: the order value of each part's first
    record, and the number of elements before it; ``total`` elements in the
    split, and ``part_rows`` records in a part."""

    split: object
    first: list[int]
    before: list[int]
    total: int
    part_rows: int


def _positions(keys: DataFrame, split_col: str, order_col: str, bucket_rows: int) -> DataFrame:
    """``keys(split, order, _len)`` with the 0-based position ``_pos`` and the
    number of elements before the record, ``_before``, in its split, and the
    split's records ``_n`` and elements ``_total``.  Two levels: a small table of sums per bucket, then windows in a bucket."""
    t = keys.withColumn("_bkt", F.floor(F.col(order_col) / F.lit(bucket_rows)).cast("bigint"))
    sums = t.groupBy(split_col, "_bkt").agg(F.sum("_len").alias("_s"), F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(split_col).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = sums.select(F.col(split_col).alias("_s"), F.col("_bkt").alias("_b"),
                       F.coalesce(F.sum("_s").over(w), zero).alias("_s0"), F.coalesce(F.sum("_c").over(w), zero).alias("_c0"),
                       F.sum("_c").over(Window.partitionBy(split_col)).alias("_n"), F.sum("_s").over(Window.partitionBy(split_col)).alias("_total"))
    w = Window.partitionBy(split_col, "_bkt").orderBy(order_col)
    inside = F.coalesce(F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, -1)), zero)
    return t.join(sums, F.col(split_col).eqNullSafe(F.col("_s")) & (F.col("_bkt") == F.col("_b"))).select(
        split_col, order_col, "_n", "_total", (F.col("_c0") + F.row_number().over(w) - 1).cast("bigint").alias("_pos"), (F.col("_s0") + inside).alias("_before"))


def part_borders(keys: DataFrame, batch_rows: int | None, split_col: str = "split", order_col: str = "row_idx",
                 bucket_rows: int = DEFAULT_BUCKET_ROWS) -> list[Borders]:
    """The parts of every split of ``keys(split, order, _len)`` (``_len``: elements
    of the record), from one job.  Collects one row for each part: at most
    ``MAX_PARTS`` a split."""
    up = lambda a, b: f"(({a}) + ({b}) - 1) div ({b})"
    want = f"greatest({up('_n', MAX_PARTS)}, least({PART_ROWS}, {up('_n', PARTS_PER_CORE * default_parallelism(keys.sparkSession))}), 1)"
    unit = batch_rows or 1
    placed = _positions(keys, split_col, order_col, bucket_rows).withColumn("_rows", F.expr(f"{up(want, unit)} * {unit}"))
    out: dict = {}
    for r in placed.where("_pos % _rows = 0").select(split_col, order_col, "_before", "_total", "_rows").collect():
        b = out.setdefault(r[split_col], Borders(r[split_col], [], [], int(r["_total"]), int(r["_rows"])))
        b.first.append(int(r[order_col]))
        b.before.append(int(r["_before"]))
    for b in out.values():
        b.first.sort()
        b.before.sort()
    return list(out.values())


def _constant(values: list[int]) -> Column:
    """An array constant, folded when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _by_split(borders: list[Borders], split_col: str, value) -> Column:
    out = F.lit(None)
    for b in borders:
        out = F.when(F.col(split_col).eqNullSafe(F.lit(b.split)), value(b)).otherwise(out)
    return out


def part_of(borders: list[Borders], split_col: str, order_col: str) -> Column:
    """Number of the part that holds the record: binary search in the borders."""
    def search(b: Borders) -> Column:
        first, steps = _constant(b.first), len(b.first).bit_length()
        start = F.struct(F.lit(0).alias("lo"), F.lit(len(b.first)).alias("hi"))      # borders at or below the value

        def halve(s, _):
            mid = ((s["lo"] + s["hi"] + 1) / 2).cast("int")
            below = F.get(first, mid - 1) <= F.col(order_col)
            return F.struct(F.when(below, mid).otherwise(s["lo"]).alias("lo"),
                            F.when(below, s["hi"]).otherwise(F.greatest(mid - 1, s["lo"])).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"] - 1)
    return _by_split(borders, split_col, search)


def pack_blocks(df: DataFrame, block_size: int, batch_rows: int | None = DEFAULT_BATCH_ROWS,
                split_col: str = "split", order_col: str = "row_idx", keep_short: bool = True,
                bucket_rows: int = DEFAULT_BUCKET_ROWS, rows: DataFrame | None = None) -> DataFrame:
    """B1 (+F11, O5): ``(split, batch_id, block_id, input_ids, attention_mask,
    labels)``.

    ``order_col`` orders records inside a split (integral, unique; it need
    not be dense).  ``keep_short=False`` drops the short block of a batch
    shorter than one block (what a strict block-size check wants).  ``rows``
    may give the table's ``(split, order_col, n_tokens)`` from a cheaper
    source (a landed table before encoding): the borders are found from it,
    so that ``df`` is computed once.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    cols = _present(df)
    keys = df.select(split_col, order_col, F.size("input_ids").alias("n_tokens")) if rows is None else rows
    keys = keys.select(split_col, order_col, (F.coalesce("n_tokens", F.lit(0)) + 1).cast("bigint").alias("_len"))
    borders = part_borders(keys, batch_rows, split_col, order_col, bucket_rows)
    d = df.select(split_col, order_col, *cols)
    if not borders:
        d = d.limit(0)
    d = d.withColumn("_part", part_of(borders, split_col, order_col).cast("int")).repartition(split_col, "_part")
    d = d.withColumn("_len", (F.coalesce(F.size("input_ids"), F.lit(0)) + 1).cast("bigint"))
    for c in cols:
        d = d.withColumn(c, append_value(c, FILL[c]))
    in_part = Window.partitionBy(split_col, "_part").orderBy(order_col)
    earlier = (Window.unboundedPreceding, -1)
    if batch_rows is None:
        base = F.get(_by_split(borders, split_col, lambda b: _constant(b.before)).cast("array<bigint>"), F.col("_part"))
        d = d.withColumns({"_start": base + F.coalesce(F.sum("_len").over(in_part.rowsBetween(*earlier)), F.lit(0)),
                           "_total": _by_split(borders, split_col, lambda b: F.lit(b.total)).cast("bigint"), "batch_id": F.lit(0).cast("bigint")})
    else:
        rank = F.row_number().over(in_part) - 1
        per_part = _by_split(borders, split_col, lambda b: F.lit(b.part_rows // batch_rows)).cast("bigint")
        d = d.withColumn("batch_id", (F.col("_part") * per_part + F.floor(rank / F.lit(batch_rows))).cast("bigint"))
        w = Window.partitionBy(split_col, "_part", "batch_id").orderBy(order_col)
        d = (d.withColumn("_start", F.coalesce(F.sum("_len").over(w.rowsBetween(*earlier)), F.lit(0)))
              .withColumn("_total", F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    bs = F.lit(block_size).cast("bigint")
    full = F.floor(F.col("_total") / bs) * bs
    keep = F.when(F.col("_total") >= bs, full).otherwise(F.col("_total")) if keep_short else full
    d = d.withColumn("_end", F.least(F.col("_start") + F.col("_len"), keep))
    d = d.where(F.col("_end") > F.col("_start"))
    d = d.withColumn("block_id", F.explode(F.sequence(F.floor(F.col("_start") / bs),
                                                      F.floor((F.col("_end") - 1) / bs))))
    lo = F.greatest(F.col("_start"), F.col("block_id") * bs)
    hi = F.least(F.col("_end"), (F.col("block_id") + 1) * bs)
    d = d.withColumn("_lo", lo).withColumn("_n", (hi - lo).cast("int"))
    d = d.withColumn("_from", (F.col("_lo") - F.col("_start") + 1).cast("int"))
    seg = F.struct(F.col("_lo"), *[F.slice(c, F.col("_from"), F.col("_n")).alias(c) for c in cols])
    where = [split_col, "batch_id", "block_id"]
    blocks = d.groupBy(split_col, "_part", "batch_id", "block_id").agg(F.sort_array(F.collect_list(seg)).alias("_segs"))
    if batch_rows is None:
        # a block that begins before its part or ends after it may have pieces in others
        last = F.get(_by_split(borders, split_col, lambda b: _constant([*b.before[1:], b.total])).cast("array<bigint>"), F.col("_part"))
        first = F.get(_by_split(borders, split_col, lambda b: _constant(b.before)).cast("array<bigint>"), F.col("_part"))
        inner = (F.col("block_id") * bs >= first) & ((F.col("block_id") + 1) * bs <= last)
        marked = blocks.withColumn("_home", F.when(inner, F.col("_part")))
        edges = marked.where("_home IS NULL").groupBy(*where).agg(F.sort_array(F.flatten(F.collect_list("_segs"))).alias("_segs"))
        blocks = marked.where("_home IS NOT NULL").select(*where, "_segs").unionByName(edges)
    return blocks.select(split_col, "batch_id", F.col("block_id").cast("bigint").alias("block_id"),
                         *[F.flatten(F.transform("_segs", _field(c))).alias(c) for c in cols])


def pad_blocks(df: DataFrame, block_size: int) -> DataFrame:
    """B2: left-pad every record to ``block_size`` (ids 50256, mask 0,
    labels -100).  ``labels`` is required; a longer record raises."""
    missing = [c for c in TOKEN_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"padding needs columns {missing}")
    out = df
    for c in TOKEN_COLS:
        out = out.withColumn(c, left_pad(c, block_size, FILL[c]))
    return out


def build_blocks(df: DataFrame, block_size: int, mode: str = "concat", **kw) -> DataFrame:
    """``concat`` (pack), ``pad`` or ``skip`` (table unchanged)."""
    if mode == "skip":
        return df
    if mode == "concat":
        return pack_blocks(df, block_size, **kw)
    if mode == "pad":
        return pad_blocks(df, block_size)
    raise ValueError(f"unknown block mode {mode!r}")


def block_mode(ignore_long_samples: bool, concatenate_texts: bool, skip_concat: bool) -> str:
    """B3 flag logic: keeping long records forces concatenation."""
    if skip_concat:
        return "skip"
    if not ignore_long_samples:
        concatenate_texts = True
    return "concat" if concatenate_texts else "pad"
