"""Text-level column expressions (F1, F3 helpers, F12 for text lists)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.constants import MARKER, TOKEN_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """split text into tokens (``array<string>``); NULL text = no tokens."""
    return F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(TOKEN_PATTERN), 1)


def tokenize_literal(s: str) -> list[str]:
    """The same tokenization applied on the driver to a short literal such as
    the marker.  The token pattern uses explicit ASCII classes, on which
    Python's ``re`` and Java regex agree."""
    return re.findall(TOKEN_PATTERN, s)


def marker_tokens(marker: str = MARKER) -> list[str]:
    toks = tokenize_literal(marker)
    if not toks:
        raise ValueError(f"marker {marker!r} has no tokens")
    return toks


def join_tokens(tokens, sep: str = " ") -> Column:
    """F3 text form: tokens joined by a separator."""
    return F.array_join(_col(tokens), sep)


def integers_in_text(text) -> Column:
    """F12 for text lists: every non-negative integer of a nested list
    literal such as ``[[0, 2], None, [5]]``, in order, as ``array<bigint>``.
    Brackets, ``None`` and separators are dropped."""
    return F.transform(F.regexp_extract_all(_col(text), F.lit(r"(\d+)"), 1),
                       lambda x: x.cast("bigint"))


def list_literal_text(values) -> Column:
    """K8 text form of an array of integers: ``[0, 2, 5]``."""
    return F.concat(F.lit("["), F.array_join(_col(values), ", "), F.lit("]"))
