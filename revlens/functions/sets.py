"""Membership in a comma-separated code list (``FIND_IN_SET`` semantics)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_code_list(codes: int | str | Iterable) -> list[str]:
    """Elements of a code list exactly as FIND_IN_SET sees them.

    A string is split on commas with no trimming: in ``'7, 70'`` the second
    element is ``' 70'``, which matches no code. Ints and iterables are
    rendered with ``str``.
    """
    if isinstance(codes, int):
        return [str(codes)]
    if isinstance(codes, str):
        return codes.split(",")
    return [str(c) for c in codes]


def code_in_list(col: Column | str, codes: int | str | Iterable) -> Column:
    """Predicate equivalent to ``FIND_IN_SET(col, codes) > 0`` for integer codes.

    Elements that are not canonical integers can never equal the text of an
    integer code, so they are dropped; the rest become an ``IN`` list that
    Catalyst pushes to the parquet scan.
    """
    c = F.col(col) if isinstance(col, str) else col
    values = sorted({int(e) for e in parse_code_list(codes) if _canonical_int(e)})
    if not values:
        return F.lit(False)
    return c.cast("bigint").isin(values) if max(map(abs, values)) > 2**31 - 1 else c.isin(values)


def restrict_to_codes(df: DataFrame, col: Column | str, codes: int | str | Iterable) -> DataFrame:
    """Filter ``df`` to rows whose ``col`` is in the code list, its schema unchanged.

    One path for every length: an ``IN`` set that Catalyst turns into a hash
    set and pushes to the scan (as a range when long).
    """
    return df.filter(code_in_list(col, codes))


def _canonical_int(text: str) -> bool:
    """True for the decimal text of a 64-bit integer as CAST(int AS CHAR) prints it."""
    return bool(re.fullmatch(r"0|-?[1-9][0-9]{0,18}", text, re.ASCII)) and -(2**63) <= int(text) < 2**63
