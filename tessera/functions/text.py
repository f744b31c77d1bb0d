"""Text rules (N12, N13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_of


# N12 — strip removes every Unicode white space at both ends, not only U+0020.
def strip(c: str | Column) -> Column:
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


# N13 — title case where every run of letters is a word ("O'Neil Foo-Bar 3Rd").
def title(c: str | Column) -> Column:
    runs = F.regexp_extract_all(col_of(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.when(col_of(c).isNull(), F.lit(None)).otherwise(
        F.array_join(F.transform(runs, lambda x: F.initcap(x)), ""))


def lower(c: str | Column) -> Column:
    return F.lower(col_of(c))


def upper(c: str | Column) -> Column:
    return F.upper(col_of(c))
