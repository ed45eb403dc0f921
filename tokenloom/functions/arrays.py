"""Array column expressions on token arrays.

All of them are native Spark expressions (higher-order functions included);
none leaves the JVM.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.constants import EOS_ID, IGNORE_LABEL, MASKED_ATTENTION


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _array_literal(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def attention_mask(ids) -> Column:
    """one ``1`` per token."""
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def truncate(arr, n: int) -> Column:
    """first ``n`` elements."""
    return F.slice(_col(arr), 1, n)


def find_all(arr, pattern: Sequence) -> Column:
    """every start position (0-based, overlapping) of ``pattern`` in ``arr``.

    Candidates are only the positions holding the pattern's first element;
    the full comparison runs on those.  A pattern longer than the array gives
    an empty array.
    """
    if len(pattern) == 0:
        raise ValueError("empty pattern")
    a = _col(arr)
    m = len(pattern)
    n = F.size(a)
    first = F.lit(pattern[0])
    if m == 1:
        pred = lambda i: F.get(a, i) == first
    else:
        p = _array_literal(pattern)
        pred = lambda i: (F.get(a, i) == first) & (F.slice(a, i + 1, m) == p)
    # the guard matters: sequence(0, -1) counts down instead of being empty
    return F.when(n >= m, F.filter(F.sequence(F.lit(0), n - m), pred)) \
            .otherwise(F.array().cast("array<int>"))


def find_first(arr, pattern: Sequence) -> Column:
    """F8: first start position of ``pattern`` or NULL when absent."""
    return F.get(find_all(arr, pattern), 0)


def mask_before(ids, idx) -> Column:
    """labels equal to ``ids`` from position ``idx`` on, ``-100`` before.
    No marker (``idx`` NULL) gives ``[-100]``."""
    a, i = _col(ids), _col(idx)
    masked = F.concat(F.array_repeat(F.lit(IGNORE_LABEL), i),
                      F.slice(a, i + 1, F.greatest(F.size(a) - i, F.lit(0))))
    return F.when(i.isNull(), F.array(F.lit(IGNORE_LABEL))).otherwise(masked)


def append_value(arr, value: int) -> Column:
    """append one end-of-sample element."""
    return F.concat(_col(arr), F.array(F.lit(value)))


def append_eos(ids, mask, labels) -> tuple[Column, Column, Column]:
    """F11 for all three token columns: ids 50256, mask 0, labels -100."""
    return (append_value(ids, EOS_ID), append_value(mask, MASKED_ATTENTION),
            append_value(labels, IGNORE_LABEL))


def left_pad(arr, block_size: int, value: int) -> Column:
    """B2 for one column: left-pad to ``block_size``; longer arrays raise."""
    a = _col(arr)
    n = F.size(a)
    return F.when(n > block_size, F.raise_error(F.format_string(
        "record of %d elements is longer than the block size " + str(block_size), n))) \
        .otherwise(F.concat(F.array_repeat(F.lit(value), F.lit(block_size) - n), a))


def argmax(values) -> Column:
    """0-based position of the first maximum."""
    a = _col(values)
    return F.array_position(a, F.array_max(a)) - 1


def first_unmasked_segment(labels) -> tuple[Column, Column]:
    """``[start, end)`` of the first run of labels that are not -100.

    ``start`` is NULL when every label is masked; ``end`` is the next -100
    after ``start`` or the array length.
    """
    a = _col(labels)
    n = F.size(a)
    ign = F.lit(IGNORE_LABEL)
    start = F.when(n > 0, F.get(F.filter(F.sequence(F.lit(0), n - 1),
                                         lambda i: F.get(a, i) != ign), 0))
    after = F.when(start.isNotNull(), F.get(F.filter(F.sequence(start, n - 1),
                                                     lambda i: F.get(a, i) == ign), 0))
    end = F.when(start.isNotNull(), F.coalesce(after, n))
    return start, end


def shifted_matches(preds, labels, ignore_masked: bool = False) -> tuple[Column, Column]:
    """A6 per row: (#positions, #matches) comparing ``preds[:-1]`` with
    ``labels[1:]``.  With ``ignore_masked`` the -100 targets are left out."""
    p, y = _col(preds), _col(labels)
    k = F.greatest(F.size(y) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(p, 1, k).alias("p"), F.slice(y, 2, k).alias("y"))
    if ignore_masked:
        pairs = F.filter(pairs, lambda s: s["y"] != F.lit(IGNORE_LABEL))
    total = F.size(pairs)
    hits = F.aggregate(pairs, F.lit(0),
                       lambda acc, s: acc + F.when(s["p"] == s["y"], 1).otherwise(0))
    return total, hits
