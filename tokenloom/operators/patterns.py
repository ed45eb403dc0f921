"""F7 for many patterns at once, in linear time.

The failure function of all patterns is worked out when the plan is made, as a
table of transitions over the patterns' own elements (any other element leads
to the start).  Tasks take Arrow batches: elements become numbers by one
vectorised lookup, stretches without an element of any pattern are passed
over, and the others are read once, one transition each, whatever the
patterns' lengths and overlaps.  For a single short pattern the native
``functions.arrays.find_all`` does without Python.
"""

from __future__ import annotations

from collections import deque
from typing import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tokenloom.operators.lookup import pieces
from tokenloom.session import bound_batches, ship_package

MAX_CELLS = 20_000_000     # of the transition table (states times elements)


class Patterns:
    """Transitions and hits of a set of patterns (element sequences)."""

    def __init__(self, patterns: Sequence[Sequence]):
        if not patterns or any(len(p) == 0 for p in patterns):
            raise ValueError("empty pattern")
        self.elements = list(dict.fromkeys(x for p in patterns for x in p))
        number = {x: k + 1 for k, x in enumerate(self.elements)}
        self.lengths = [len(p) for p in patterns]
        width = len(self.elements) + 1
        if (sum(self.lengths) + 1) * width > MAX_CELLS:
            raise ValueError(f"patterns need a table of more than {MAX_CELLS} cells")
        step: list[list[int]] = [[0] * width]        # 0: no edge yet, or back to the start
        hits: list[list[int]] = [[]]
        for k, p in enumerate(patterns):
            state = 0
            for x in p:
                if not step[state][number[x]]:
                    step[state][number[x]] = len(step)
                    step.append([0] * width)
                    hits.append([])
                state = step[state][number[x]]
            hits[state].append(k)
        # breadth first: a missing edge is the one of the longest proper suffix that is a state
        fail, queue = [0] * len(step), deque(s for s in step[0] if s)
        while queue:
            state = queue.popleft()
            hits[state] = hits[state] + hits[fail[state]]
            for c in range(1, width):
                after, other = step[state][c], step[fail[state]][c]
                if after:
                    fail[after] = other
                    queue.append(after)
                else:
                    step[state][c] = other
        self.step, self.hits = step, [tuple(sorted(h)) for h in hits]

    def find(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches in flat ``codes`` of rows: row, pattern and start in the row,
        by row, end and pattern."""
        known = codes > 0
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[heads] |= known[heads]
        starts = np.flatnonzero(opens)
        closes = np.flatnonzero(known & np.append(~known[1:] | opens[1:], True)) + 1
        rows = np.searchsorted(offsets, starts, "right") - 1
        step, hits, lengths = self.step, self.hits, self.lengths
        out: list[tuple[int, int, int]] = []
        for row, lo, hi in zip(rows.tolist(), starts.tolist(), closes.tolist()):
            state, base = 0, int(offsets[row])
            for at, code in enumerate(codes[lo:hi].tolist(), lo + 1):
                state = step[state][code]
                if hits[state]:
                    for k in hits[state]:
                        out.append((row, k, at - lengths[k] - base))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.array(c, np.int64) for c in zip(*out))


def _matches(automaton: Patterns, arr_col: str, out_col: str, kind: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        elements = pa.array(automaton.elements, kind)
        for b in pieces(batches, arr_col):
            column = b.column(b.schema.get_field_index(arr_col))
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            codes = pc.fill_null(pc.index_in(column.flatten().cast(kind), value_set=elements), -1).to_numpy(zero_copy_only=False) + 1
            row, pattern, start = automaton.find(codes.astype(np.int64), offsets)
            by = np.lexsort((pattern, start, row))
            ends = np.searchsorted(row[by], np.arange(b.num_rows + 1))
            found = pa.StructArray.from_arrays([pa.array(pattern[by].astype(np.int32)), pa.array(start[by].astype(np.int32))], names=["pattern", "start"])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found)], names=[*b.schema.names, out_col])
    return run


def find_patterns(df: DataFrame, patterns: Sequence[Sequence], arr_col: str = "tokens", out_col: str = "matches") -> DataFrame:
    """``df`` with ``out_col``: all matches (overlapping ones too) of ``patterns``
    in the array ``arr_col``, as ``(pattern, start)`` by start, then pattern;
    ``pattern`` is the place in ``patterns``.  A null array has none."""
    if out_col in df.columns:
        raise ValueError(f"column {out_col} is there already")
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    automaton = Patterns(patterns)
    kind = pa.string() if isinstance(automaton.elements[0], str) else pa.int64()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out_col}` array<struct<pattern:int,start:int>>"
    return df.mapInArrow(_matches(automaton, arr_col, out_col, kind), schema)
