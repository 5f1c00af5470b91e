"""Hypergeometric upper tails and Benjamini-Hochberg adjustment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.operators.checkpoints import checkpointed

#: Rows up to which windows over whole families adjust; beyond, ranges of p-values are adjusted side by side. Both give the same.
ONE_TASK = 200_000
#: Standard deviations, and terms beyond them, after which the rest of a tail is below 1e-17 of its sum.
DEVIATIONS, TERMS = 12, 64


def _let(name: str, value: str, body: str) -> str:
    """SQL of a body in which a name stands for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _stirling_error(k: str) -> str:
    """log k! less Stirling's approximation: the series from 16 on, below a short table."""
    small = ", ".join(["0.0D", *(f"{math.lgamma(i + 1) - (i + 0.5) * math.log(i) + i - 0.5 * math.log(2 * math.pi)!r}D" for i in range(1, 16))])
    return f"CASE WHEN {k} < 16 THEN array({small})[CAST({k} AS INT)] ELSE {_let('r', f'1 / ({k} * {k})', f'({1 / 12!r}D - ({1 / 360!r}D - ({1 / 1260!r}D - r / 1680) * r) * r) / {k}')} END"


def _deviance(x: str, mean: str) -> str:
    """x log(x / mean) + mean - x, without cancellation where x is near the mean."""
    series = "0.0D"
    for j in range(9, 0, -1):
        series = f"({series} + {1 / (2 * j + 1)!r}D) * w"
    near = _let("w", "v * v", f"({x} - m) * v + 2 * {x} * v * {series}")
    return _let("m", mean, _let("v", f"({x} - m) / ({x} + m)", f"CASE WHEN abs(v) < 0.1D THEN {near} ELSE {x} * ln({x} / m) + m - {x} END"))


def _log_binomial(x: str, n: str) -> str:
    """log P(X = x) of n draws with chances b.p and b.q = 1 - b.p, both above 0."""
    inner = f"{_stirling_error('n')} - {_stirling_error('x')} - {_stirling_error('y')} - {_deviance('x', 'n * b.p')} - {_deviance('y', 'n * b.q')} - 0.5D * ({math.log(2 * math.pi)!r}D + ln(x) + log1p(-x / n))"
    none = "n * CASE WHEN b.p < 0.1D THEN log1p(-b.p) ELSE ln(b.q) END"
    all_ = "n * CASE WHEN b.q < 0.1D THEN log1p(-b.q) ELSE ln(b.p) END"
    return _let("x", x, _let("n", n, f"CASE WHEN x = 0 THEN {none} WHEN x = n THEN {all_} ELSE {_let('y', 'n - x', inner)} END"))


def hypergeometric_tail(x: str, successes: str, population: str, draws: str) -> Column:
    """P(X >= x) where ``draws`` of ``population`` are drawn and ``successes`` of it count; clamped to [0, 1]. Arguments are SQL.

    The first term comes from three binomial ones (a saddle-point expansion, exact to some 1e-14), each next from the
    ratio of neighbours. From the mean on the sum runs up from x; below it, the other side runs down and is taken
    from 1. Terms decay like those of a normal or Poisson tail, so their number follows the standard deviation.
    """
    given = ", ".join(f"'{name}', CAST({c} AS DOUBLE)" for name, c in (("x", x), ("k", successes), ("n", population), ("d", draws)))
    bounds = "named_struct('low', greatest(0.0D, g.d + g.k - g.n), 'top', least(g.k, g.d), 'mean', g.d * g.k / g.n, 'p', g.d / g.n, 'q', (g.n - g.d) / g.n, 'up', g.x > g.d * g.k / g.n)"
    first = f"exp({_log_binomial('s', 'g.k')} + {_log_binomial('g.d - s', 'g.n - g.k')} - {_log_binomial('g.d', 'g.n')})"
    most = f"floor({DEVIATIONS} * sqrt(b.mean * (1 - g.k / g.n) * (g.n - g.d) / (g.n - 1))) + {TERMS}"
    places = _let("steps", f"CAST(least(CASE WHEN b.up THEN b.top - s ELSE s - b.low END, {most}) AS INT)", "CASE WHEN steps > 0 THEN sequence(1, steps) ELSE CAST(array() AS ARRAY<INT>) END")
    # j: the place before
    ratio = "CASE WHEN b.up THEN (g.k - j) * (g.d - j) / ((j + 1) * (g.n - g.k - g.d + j + 1)) ELSE j * (g.n - g.k - g.d + j) / ((g.k - j + 1) * (g.d - j + 1)) END"
    add = _let("t", f"a.term * {_let('j', 'CASE WHEN b.up THEN s + i - 1 ELSE s - i + 1 END', ratio)}", "named_struct('term', t, 'total', a.total + t)")
    side = _let("f", first, f"aggregate({places}, named_struct('term', f, 'total', f), (a, i) -> {add}, a -> a.total)")
    inside = _let("s", "CASE WHEN b.up THEN g.x ELSE g.x - 1 END", _let("side", side, "greatest(0.0D, least(1.0D, CASE WHEN b.up THEN side ELSE 1 - side END))"))
    # between the bounds neither draws nor successes are none or all
    return F.expr(_let("g", f"named_struct({given})", f"CASE WHEN g.x <= greatest(0.0D, g.d + g.k - g.n) THEN 1.0D WHEN g.x > least(g.k, g.d) THEN 0.0D ELSE {_let('b', bounds, inside)} END"))


def benjamini_hochberg(p: Column, partition: list[str], ties: list[Column], tests: Column | None = None) -> Column:
    """Adjusted p-values within each partition of tests; null p-values are not tests.

    ``tests`` is their number where tests of p = 1 are not among the rows; those change no other's rank. A window
    holds a whole partition: ``adjusted`` is for long ones.
    """
    tests = F.count(p).over(W.partitionBy(*partition)) if tests is None else tests
    rank = F.rank().over(W.partitionBy(*partition).orderBy(p.asc_nulls_last()))
    # equal p-values take the greatest rank among them
    same = F.count(p).over(W.partitionBy(*partition, p))
    raw = p * tests / (rank + same - 1)
    from_top = W.partitionBy(*partition).orderBy(p.desc_nulls_last(), *ties).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.when(p.isNotNull(), F.least(F.lit(1.0), F.min(raw).over(from_top)))


def adjusted(rows: DataFrame, p: str, name: str, family: list[str] | None = None, tests: str | None = None, one_task: int = ONE_TASK, count: int | None = None) -> DataFrame:
    """Adds Benjamini-Hochberg values of ``p`` within each family (the whole table, unless named), however long it is.

    Equal p-values are counted first. The distinct ones are dealt out by range of (family, p); a value's rank is the
    sum of the ranges before and of its own range up to it, and the least over greater p-values is that of its own
    range from it on and of the ranges after. Sums and minima of ranges, a row for each family in a range, are all
    that is scanned in order. ``tests`` as in ``benjamini_hochberg``.
    """
    family = family or []
    if (rows.count() if count is None else count) <= one_task:
        return rows.withColumn(name, benjamini_hochberg(F.col(p), family, [F.lit(0)], F.col(tests) if tests else None))
    distinct = rows.where(F.col(p).isNotNull()).groupBy(*family, F.col(p).alias("p__")).agg(F.count(F.lit(1)).alias("n__"), *([F.max(tests).alias("tests__")] if tests else []))
    dealt = checkpointed(distinct.repartitionByRange(*family, "p__").withColumn("part__", F.spark_partition_id()))
    ranges = dealt.groupBy(*family, "part__").agg(F.sum("n__").alias("sum__"))
    in_order = W.partitionBy(*family).orderBy("part__")
    before = ranges.select(*family, "part__", (F.sum("sum__").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("sum__")).alias("before__"), *([] if tests else [F.sum("sum__").over(W.partitionBy(*family)).alias("tests__")]))
    same = lambda df, keys: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]

    def beside(a: DataFrame, b: DataFrame, keys: list[str], add: list[str], how: str = "inner") -> DataFrame:
        on = same(a, keys)
        cond = on[0]
        for c in on[1:]:
            cond &= c
        return a.alias("a").join(b.alias("b"), cond, how).select("a.*", *(f"b.{c}" for c in add))

    # sums go up and minima down: a frame to the end of its partition would be computed anew for every row
    own, down = W.partitionBy(*family, "part__").orderBy("p__"), W.partitionBy(*family, "part__").orderBy(F.desc("p__"))
    placed = beside(dealt, before, [*family, "part__"], ["before__", *([] if tests else ["tests__"])])
    raw = placed.withColumn("raw__", F.col("p__") * F.col("tests__") / (F.col("before__") + F.sum("n__").over(own.rowsBetween(W.unboundedPreceding, W.currentRow))))
    raw = checkpointed(raw.withColumn("least__", F.min("raw__").over(down.rowsBetween(W.unboundedPreceding, W.currentRow))))
    after = raw.groupBy(*family, "part__").agg(F.min("raw__").alias("range__")).withColumn("after__", F.min("range__").over(W.partitionBy(*family).orderBy(F.desc("part__")).rowsBetween(W.unboundedPreceding, -1)))
    known = checkpointed(beside(raw, after, [*family, "part__"], ["after__"]).select(*family, "p__", F.least(F.lit(1.0), "least__", "after__").alias(name)))
    # both sides are plain exchanges, so a p-value that many rows share is split
    return beside(rows.withColumn("p__", F.col(p)), known, [*family, "p__"], [name], "left").drop("p__")
