"""Data-quality rules as Column predicates, with a report and a quarantine split.

A rule is (name, passes) where ``passes`` is True for a good row. A NULL in the
checked column passes every rule except ``not_null``. ``quality_report``
counts checked/failed rows per rule in one aggregate; ``split`` tags each row
with the array of rules it fails and returns (good, quarantined).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_list

# Fixed value: the address pattern the reference validates with.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    passes: Column
    kind: str = "check"          # "not_null" rules check every row, the others only non-null values


def _null_ok(c: str, cond: Column) -> Column:
    return F.col(c).isNull() | F.coalesce(cond, F.lit(False))


def email(c: str, name: str | None = None) -> Rule:
    return Rule(name or f"{c}_email", c, _null_ok(c, F.col(c).rlike(EMAIL_PATTERN)))


def date(c: str, fmt: str = "yyyy-M-d", name: str | None = None) -> Rule:
    """Parses in ``fmt``. ``yyyy-M-d`` accepts padded and unpadded fields like Python's strptime."""
    return Rule(name or f"{c}_date", c, _null_ok(c, F.try_to_timestamp(F.col(c).cast("string"), F.lit(fmt))
                                                  .isNotNull()))


def date_range(start: str, end: str, name: str | None = None) -> Rule:
    ok = F.col(start).isNull() | F.col(end).isNull() | (F.col(start) <= F.col(end))
    return Rule(name or f"{start}_le_{end}", start, ok)


def numeric_range(c: str, lo=None, hi=None, name: str | None = None) -> Rule:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(c) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(c) <= F.lit(hi))
    return Rule(name or f"{c}_range", c, _null_ok(c, cond))


def length(c: str, lo: int | None = None, hi: int | None = None, name: str | None = None) -> Rule:
    n = F.char_length(F.col(c))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (n >= lo)
    if hi is not None:
        cond = cond & (n <= hi)
    return Rule(name or f"{c}_length", c, _null_ok(c, cond))


def choice(c: str, choices: Sequence, name: str | None = None) -> Rule:
    return Rule(name or f"{c}_choice", c, _null_ok(c, F.col(c).isin(list(choices))))


def not_null(c: str, name: str | None = None) -> Rule:
    return Rule(name or f"{c}_not_null", c, F.col(c).isNotNull(), "not_null")


def with_failures(df: DataFrame, rules: Sequence[Rule], output: str = "failed_rules") -> DataFrame:
    tags = F.array(*[F.when(~r.passes, F.lit(r.name)) for r in rules])
    return df.withColumn(output, F.filter(tags, lambda x: x.isNotNull()))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    tagged = with_failures(df, rules)
    good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.where(F.size("failed_rules") > 0)
    return good, bad


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, checked, failed): checked = non-null values of the rule's column
    (all rows for not_null), in one aggregate."""
    parts = []
    for r in rules:
        checked = F.count(F.lit(1)) if r.kind == "not_null" else F.count(F.col(r.column))
        parts.append(F.struct(F.lit(r.name).alias("rule"), checked.alias("checked"),
                              F.count_if(~r.passes).alias("failed")))
    return df.agg(F.array(*parts).alias("__r")).select(F.inline("__r"))


def validate_table(df: DataFrame, required_columns: Sequence[str] = (), min_rows: int | None = None,
                   max_rows: int | None = None) -> DataFrame:
    """One row: missing_columns (from the schema), row_count, ok."""
    missing = [c for c in as_list(required_columns) if c not in df.columns]
    n = F.count(F.lit(1))
    ok = F.lit(not missing)
    if min_rows is not None:
        ok = ok & (n >= min_rows)
    if max_rows is not None:
        ok = ok & (n <= max_rows)
    return df.agg(F.array(*[F.lit(m) for m in missing]).cast("array<string>").alias("missing_columns"),
                  n.alias("row_count"), ok.alias("ok"))
