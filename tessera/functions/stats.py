"""Global statistics computed without gathering a column into one task.

Spark's exact ``percentile`` and ``mode`` aggregates merge a value→count map
of the whole column in a single task; on a large table that map is the
column's distinct values. The forms here stay distributed:

- quantiles: one mergeable sketch per column brackets every rank; counts of
  the rows below, at and inside the brackets select the exact values. Only
  counts and sketches reach the driver.
- quantiles per group, unique and most frequent values: one index of
  (group, column, value, count) from a single read, for all columns.
- mode: per-value counts, then the top one by (count desc, value asc) —
  each partition keeps its best row before the merge.

Results come back as plain Python values (one bounded row), to be used as
literals, so a statistic is computed once however often it is referenced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def one_row(agg_df: DataFrame) -> Row:
    """The single row of a global aggregate (bounded: one row)."""
    rows = agg_df.take(1)
    return rows[0] if rows else None


SKETCH_K = 16_384            # size of a quantile sketch; it holds so many values exactly
RANK_ERROR = 2.296 / SKETCH_K ** 0.9021      # normalised rank error of a KLL sketch of that size (fixed formula)


def _from_sketches(spark, asks: list[tuple[bytes, list[float]]]) -> list[list[float]]:
    """Quantiles of collected sketches; the expressions are constants, so no job runs."""
    if not asks:
        return []
    cols = [F.kll_sketch_get_quantile_double(F.lit(bytearray(s)), F.array(*[F.lit(min(1.0, max(0.0, r))) for r in ranks]))
            for s, ranks in asks]
    return [list(v) for v in spark.sql("SELECT 1 AS one").select(*[c.alias(f"q{i}") for i, c in enumerate(cols)]).first()]


def _bracket_counts(x: Column, lo: float, hi: float, name: str) -> list[Column]:
    """Rows below, at and between the ends of a bracket, and a sketch of those between."""
    inside = (x > lo) & (x < hi)
    return [F.count(F.when(x < lo, 1)).alias(f"{name}b"), F.count(F.when(x == lo, 1)).alias(f"{name}l"),
            F.count(F.when(inside, 1)).alias(f"{name}i"), F.count(F.when((x == hi) & (x != lo), 1)).alias(f"{name}h"),
            F.kll_sketch_agg_double(F.when(inside, x), F.lit(SKETCH_K)).alias(f"{name}s")]


def exact_quantiles_of(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles (pandas/numpy default, N10) of the non-missing values of each column.

    Exact, distributed, and one form for every size: all columns and quantiles
    share each pass. The first pass makes one mergeable KLL sketch per column,
    which brackets every wanted rank. A later pass counts, for each bracket, the rows
    below it, at its two ends (so a value repeated many times is counted, not
    collected) and inside, and sketches the inside. A sketch of at most
    ``SKETCH_K`` values is exact, so the rank is read from it; otherwise it gives the next,
    some 200 times narrower bracket. A rank outside its bracket (sketches err with small
    probability) starts again from the whole range with a wider margin. The driver gets
    one row of counts and sketches a pass, never the values. Two passes do for
    3 million rows, three for 600 million, four beyond.
    """
    cols = list(columns)
    base = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    base = base.select(*[F.when(~F.isnan(f"c{i}"), F.col(f"c{i}")).alias(f"c{i}") for i in range(len(cols))])
    x = [F.col(f"c{i}") for i in range(len(cols))]
    row = one_row(base.agg(*[e for i, c in enumerate(x) for e in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
        F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(f"s{i}"))]))
    found: dict[tuple[int, int], float] = {}
    todo: dict[tuple[int, int, int], float] = {}              # column and two ranks -> margin of the next bracket
    for i in range(len(cols)):
        n = row[f"n{i}"]
        for q in qs if n else ():
            at = math.floor((n - 1) * q)
            todo[i, at, min(at + 1, n - 1)] = 2.5 * RANK_ERROR
    asks, brackets = [], {}
    for (i, a, b), margin in todo.items():
        n = row[f"n{i}"]
        asks.append((row[f"s{i}"], [(a + 0.5) / n, (b + 0.5) / n] if n <= SKETCH_K else [a / n - margin, (b + 1) / n + margin]))
    for key, v in zip(list(todo), _from_sketches(df.sparkSession, asks)):
        i, a, b = key
        if row[f"n{i}"] <= SKETCH_K:
            found[i, a], found[i, b] = v
            del todo[key]
        else:
            brackets[key] = tuple(v)
    while todo:
        keys = list(todo)
        got = one_row(base.agg(*[e for k, (i, a, b) in enumerate(keys)
                                 for e in _bracket_counts(x[i], *brackets[i, a, b], f"t{k}_")]))
        asks, askers = [], []
        for k, key in enumerate(keys):
            i, a, b = key
            below, low, inside, high = (got[f"t{k}_{e}"] for e in "blih")
            lo, hi = brackets[key]
            if a < below or b >= below + low + inside + high:
                brackets[key], todo[key] = (row[f"lo{i}"], row[f"hi{i}"]), min(0.2, 4 * todo[key])
                continue
            rest = []
            for t in (a, b):
                if t < below + low:
                    found[i, t] = lo
                elif t >= below + low + inside:
                    found[i, t] = hi
                else:
                    rest.append(t)
            if not rest:
                del todo[key]
                continue
            u, w = rest[0] - below - low, rest[-1] - below - low
            askers.append((key, rest, inside))
            asks.append((got[f"t{k}_s"], [(u + 0.5) / inside, (w + 0.5) / inside] if inside <= SKETCH_K
                         else [u / inside - todo[key], (w + 1) / inside + todo[key]]))
        for (key, rest, inside), v in zip(askers, _from_sketches(df.sparkSession, asks)):
            if inside <= SKETCH_K:
                found.update({(key[0], rest[0]): v[0], (key[0], rest[-1]): v[1]})
                del todo[key]
            else:
                brackets[key] = tuple(v)
    out = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        h = [(n - 1) * q for q in qs] if n else []
        ends = [(t, found[i, math.floor(t)], found[i, min(math.floor(t) + 1, n - 1)]) for t in h]
        out[c] = [lo + (t - math.floor(t)) * (hi - lo) for t, lo, hi in ends] if n else [None for _ in qs]
    return out


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float]) -> list[float | None]:
    return exact_quantiles_of(df, [column], qs)[column]


def approx_quantiles(df: DataFrame, column: str, qs: Sequence[float], accuracy: int = 100000) -> list:
    r = one_row(df.agg(F.percentile_approx(F.col(column).cast("double"), list(qs), accuracy).alias("q")))
    return list(r["q"]) if r and r["q"] is not None else [None for _ in qs]


def quantiles(df: DataFrame, column: str, qs: Sequence[float], exact: bool = True) -> list:
    return exact_quantiles(df, column, qs) if exact else approx_quantiles(df, column, qs)


def mode_and_count(df: DataFrame, column: str):
    """(most frequent non-null value, its count); ties → smallest value (N11)."""
    c = F.col(column)
    top = (df.where(c.isNotNull()).groupBy(c.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
           .orderBy(F.col("__n").desc(), F.col("__v").asc()).limit(1).collect())
    return (top[0]["__v"], top[0]["__n"]) if top else (None, 0)


def value_index(df: DataFrame, keys: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    """``keys, __c, __x, __n``: how often each value of each column (number ``__c``) occurs per group, written once.

    One read of the input serves all columns; each row becomes one short row per
    column, which the partial aggregate counts before the shuffle.
    """
    ensure_checkpoint_dir(df.sparkSession)
    entries = [F.struct(F.lit(i).alias("__c"), F.col(c).cast(kind).alias("__x")) for i, c in enumerate(columns)]
    return (df.select(*keys, F.inline(F.array(*entries))).where(F.col("__x").isNotNull())
            .groupBy(*keys, "__c", "__x").agg(F.count(F.lit(1)).alias("__n")).checkpoint(eager=True))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], wanted: Sequence[tuple[str, float, str]]) -> DataFrame:
    """Exact linear-interpolation quantiles per group of ``keys`` (NULL keys dropped, N1).

    ``wanted``: (column, q, output) triples; all of them come from one value index, i.e. one
    evaluation of the input: counts per (group, column, value), one running count for
    all columns (bucketed, so a hot group spreads), the totals, and the rows
    that cover the target ranks. A group without values has NULLs.
    """
    from ..operators.windows import cumulative_sum

    keys = list(keys)
    src = df
    for k in keys:
        src = src.where(F.col(k).isNotNull())
    columns = list(dict.fromkeys(c for c, _, _ in wanted))
    src = src.select(*keys, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"__v{i}")
                              for i, c in enumerate(columns)])
    vals = value_index(src, keys, [f"__v{i}" for i in range(len(columns))], "double")
    cum = cumulative_sum(vals, "__n", ["__x"], partition_by=[*keys, "__c"], output="__le")
    j = cum.join(vals.groupBy(*keys, "__c").agg(F.sum("__n").alias("__t")), [*keys, "__c"])
    start, aggs, outs = F.col("__le") - F.col("__n"), [], []
    for k, (c, q, name) in enumerate(wanted):
        own = F.col("__c") == columns.index(c)
        h = (F.col("__t") - 1) * F.lit(float(q))
        lo = F.floor(h)
        hi = F.least(lo + 1, F.col("__t") - 1)
        aggs += [F.max(F.when(own & (start <= t) & (t < F.col("__le")), F.col("__x"))).alias(f"__{e}{k}") for e, t in (("a", lo), ("b", hi))]
        aggs.append(F.max(F.when(own, h - lo)).alias(f"__h{k}"))
        outs.append((F.col(f"__a{k}") + F.col(f"__h{k}") * (F.col(f"__b{k}") - F.col(f"__a{k}"))).alias(name))
    return j.groupBy(*keys).agg(*aggs).select(*keys, *outs)


def grouped_quantile(df: DataFrame, keys: Sequence[str], column: str, q: float, output: str) -> DataFrame:
    """One quantile of one column per group, see ``grouped_quantiles``."""
    return grouped_quantiles(df, keys, [(column, q, output)])


def grouped_modes(df: DataFrame, keys: Sequence[str], column: str, output: str) -> DataFrame:
    """Most frequent non-NULL value per group, ties → smallest (N11): counts per (group, value), then the best of
    them, both with partial aggregation, so neither a group nor its values meet in one task."""
    kind = df.schema[column].dataType.simpleString()
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col("__x").alias("x")))
    return value_index(df, keys, [column], kind).groupBy(*keys).agg(best.alias("__b")).select(*keys, F.col("__b.x").alias(output))


def top_values(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """(distinct values, most frequent value, its count) per string column, ties → smallest value (N11), from one value index."""
    if not columns:
        return {}
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col("__x").alias("x")))
    rows = value_index(df, [], columns, "string").groupBy("__c").agg(F.count(F.lit(1)).alias("u"), best.alias("best")).collect()
    at = {r["__c"]: (r["u"], r["best"]["x"], -r["best"]["n"]) for r in rows}          # one row per column
    return {c: at.get(i, (0, None, 0)) for i, c in enumerate(columns)}
