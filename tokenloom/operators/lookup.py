"""Lookup of array elements in a table, inside the row.

``map_array`` replaces every element of an array column by its value in a
``(key, value)`` table without exploding the arrays.  The table has two parts:

* the head, a bounded number of entries of bounded size, chosen so that it
  holds the common keys.  It is collected, broadcast as one Arrow table and
  looked up by vectorised hashing over Arrow batches;
* the tail, everything else.  Only when there is one, each record's distinct
  elements outside the head are joined with it by a shuffle, one small row
  for each, and come back to the record as a short list.

Both parts give the same values, so the size of the head changes the speed
and never the result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Any, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import bound_batches, land, ship_package

#: Longest element, in bytes, that is kept as it is; a longer one is looked up by its hash.
SHORT_BYTES = 64

#: Elements that a task works on at a time; a row with more is a piece of its own.
PIECE_ELEMENTS = 1 << 19


@dataclass
class Head:
    """A broadcast head; ``whole``: the table has no tail."""

    entries: Any
    whole: bool


def short_key(column) -> F.Column:
    """A string of at most ``SHORT_BYTES`` + 1 bytes in the place of ``column``:
    itself, or a blank and its hash.  (Tokens hold no blank.)"""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.octet_length(c) <= SHORT_BYTES, c).otherwise(F.concat(F.lit(" "), F.sha2(c, 256)))


def _short_keys(values: pa.Array) -> pa.Array:
    """``short_key`` on an Arrow array."""
    long = pc.greater(pc.binary_length(values), SHORT_BYTES)
    if not pc.any(long).as_py():
        return values
    hashed = [" " + hashlib.sha256(v.encode()).hexdigest() for v in values.filter(long).to_pylist()]
    return pc.replace_with_mask(values, pc.fill_null(long, False), pa.array(hashed, pa.string()))


def make_head(table: DataFrame, in_head: F.Column) -> Head:
    """Broadcast the entries of ``table(key, value)`` that ``in_head`` selects;
    the caller bounds their number and size."""
    head = table.where(in_head).select("key", "value").toArrow().combine_chunks()
    return Head(table.sparkSession.sparkContext.broadcast(head), table.where(~F.coalesce(in_head, F.lit(False))).isEmpty())


def pieces(batches: Iterable[pa.RecordBatch], arr_col: str, elements: int = PIECE_ELEMENTS) -> Iterable[pa.RecordBatch]:
    """The batches cut into stretches of rows whose arrays hold about
    ``elements`` elements together, so that a task's memory goes by that number."""
    for b in batches:
        counts = pc.fill_null(pc.list_value_length(b.column(b.schema.get_field_index(arr_col))), 0)
        ends = np.cumsum(counts.to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + elements, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def _flat(column: pa.Array, kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    """``(elements, offsets)`` of a list column; a null list is empty."""
    counts = pc.fill_null(pc.list_value_length(column), 0)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])
    return column.flatten().cast(kind), offsets


_PLACES: list[tuple[Any, dict]] = []      # of a worker: its last head and the places of the keys


def _places(head: pa.Table) -> dict:
    """Place of every key of a head; made once per worker and head."""
    for known, places in _PLACES:
        if known is head:
            return places
    _PLACES.clear()                       # one head at a time
    places = {k: i for i, k in enumerate(head["key"].to_numpy().tolist())}
    _PLACES.append((head, places))
    return places


def _look_up(keys: pa.Array, places: dict) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The distinct ``keys``, the place of each in the head (null where there is
    none), and the number among them of every key; one look at the head each."""
    coded = keys.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    place = np.fromiter((places.get(k, -1) for k in distinct), np.int32, len(distinct))
    return coded.dictionary, pa.array(place, mask=place < 0), coded.indices


def _outside(entries, arr_col: str, keys: Sequence[str], kind: pa.DataType):
    """Each record's distinct elements that the head does not hold."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        places = _places(entries.value)
        for b in pieces(batches, arr_col):
            flat, offsets = _flat(b.column(arr_col), kind)
            distinct, place, code = _look_up(_short_keys(flat) if pa.types.is_string(kind) else flat, places)
            if not len(distinct):
                continue
            row = np.repeat(np.arange(b.num_rows, dtype=np.int64), np.diff(offsets.to_numpy()))
            code = pc.fill_null(code, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            outside = np.append(place.is_null().to_numpy(zero_copy_only=False), False)      # last: a null element
            new = outside[code]
            row, code = np.divmod(np.unique(row[new] * len(distinct) + code[new]), len(distinct))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(row)) for c in keys), distinct.take(pa.array(code))],
                                             names=[*keys, "_key"])
    return run


def _mapped(entries, arr_col: str, out_col: str, carry: Sequence[str], kind: pa.DataType, value: pa.DataType, tail: bool):
    """Every element's value from the head and the batch's own tail entries."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        places = _places(entries.value)
        head_values = entries.value["value"].combine_chunks().cast(value)
        for b in pieces(batches, arr_col):
            flat, offsets = _flat(b.column(arr_col), kind)
            distinct, place, code = _look_up(_short_keys(flat) if pa.types.is_string(kind) else flat, places)
            found = head_values.take(place)
            if tail:
                pairs = b.column("_tail").flatten()
                if len(pairs):
                    rest = pc.index_in(distinct, value_set=pairs.field("_key").cast(kind))
                    found = pc.if_else(pc.is_valid(place), found, pairs.field("_value").cast(value).take(rest))
            arrays = [b.column(c) for c in carry] + [pa.ListArray.from_arrays(offsets, found.take(code))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*carry, out_col])
    return run


_ARROW = {"string": pa.string(), "int": pa.int32()}


def map_array(df: DataFrame, key_cols: Sequence[str], arr_col: str, out_col: str, table: DataFrame, head: Head,
              key_type: str, value_type: str, landed: bool = False) -> DataFrame:
    """``df`` with ``out_col`` (an array of ``table``'s values, null for an
    element that the table does not hold) in the place of ``arr_col``.

    ``table(key, value)`` has unique keys, of ``short_key`` form if strings;
    ``key_cols`` identify a row.  A null or empty array gives an empty one.
    ``landed``: ``df`` is read from files as it is, so nothing is lost when
    the search for tail elements and the mapping each read it.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    kind, value = _ARROW[key_type], _ARROW[value_type]
    keys, carry = list(key_cols), [c for c in df.columns if c != arr_col]
    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    if not head.whole:
        df = df if landed else land(df, "lookup")    # read by the search for tail elements and by the mapping
        searched = df.select(*keys, arr_col).mapInArrow(
            _outside(head.entries, arr_col, keys, kind), ", ".join(f"`{c}` {fields[c]}" for c in keys) + f", _key {key_type}")
        tails = (searched.join(table.select(F.col("key").alias("_key"), F.col("value").alias("_value")), "_key")
                 .groupBy(*keys).agg(F.collect_list(F.struct("_key", "_value")).alias("_tail")))
        df = df.join(tails, keys, "left")
    schema = ", ".join(f"`{c}` {fields[c]}" for c in carry) + f"{', ' if carry else ''}`{out_col}` array<{value_type}>"
    return df.mapInArrow(_mapped(head.entries, arr_col, out_col, carry, kind, value, not head.whole), schema)
