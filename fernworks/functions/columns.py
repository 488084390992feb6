"""Column expressions that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip01(x: Column) -> Column:
    """x limited to [0, 1]; null stays null (least and greatest alone would skip it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def mean_of_present(*columns: Column) -> Column:
    """Mean over those columns that are not null; null if none is."""
    total = reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0.0)) for c in columns))
    return F.try_divide(total, reduce(lambda a, b: a + b, (c.isNotNull().cast("int") for c in columns)))


def number(x: Column) -> Column:
    """x as double; what is no number, and NaN, is null."""
    d = x.try_cast("double") if hasattr(x, "try_cast") else F.expr(f"try_cast({x} as double)")
    return F.when(~F.isnan(d), d)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column, floor: float = 1e-10) -> Column:
    return F.greatest(F.sqrt(dot(a, a)), F.lit(floor))


def weighted_mean(x: Column, w: Column) -> Column:
    """sum(x w) / sum(w) in a group; the plain mean where the weights sum to zero."""
    return F.coalesce(F.try_divide(F.sum(x * w), F.sum(w)), F.avg(x))


def yes_probability(log_yes: Column, log_no: Column) -> Column:
    """yes / (yes + no) from two log-probabilities."""
    return 1.0 / (1.0 + F.exp(log_no - log_yes))


def expected_rating(logs: Column) -> Column:
    """The sum of i * p(i) over ratings from 1, p being the exponentials of an array of log-probabilities scaled to sum to one."""
    add = lambda a, x: a + x
    p = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.aggregate(F.transform(p, lambda x, i: x * (i + 1)), F.lit(0.0), add) / F.aggregate(p, F.lit(0.0), add)


def joined(left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str], how: str = "inner") -> DataFrame:
    """left and right joined on `on`; columns that both have get a suffix each."""
    both = set(left.columns) & set(right.columns) - {on}
    named = lambda df, suffix: df.select(*[F.col(c).alias(c + suffix) if c in both else F.col(c) for c in df.columns])
    return named(left, suffixes[0]).join(named(right, suffixes[1]), on, how)
