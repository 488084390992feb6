"""Descriptive statistics in DataFrame operations."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.workers import prepare
from ..sources.files import kept


def average_rank(value: Column | str, *keys: str, descending: bool = False) -> Column:
    """Rank from 1 among the rows of keys, equal values sharing the mean of their places.

    Without keys all rows meet in one task: for small tables only.
    """
    v = F.col(value) if isinstance(value, str) else value
    order = Window.partitionBy(*keys).orderBy(v.desc() if descending else v.asc())
    return F.rank().over(order) + (F.count(F.lit(1)).over(Window.partitionBy(*keys, v)) - 1) / 2.0


def in_cells(df: DataFrame, value: str, alias: str = "_cell", cells: int = 256, of: DataFrame | None = None) -> DataFrame:
    """df with the number of the cell that its value is in; cells follow the order of values and are about equally full
    (their bounds are quantiles of df, or of another table), and equal values share one. Null is in a cell before all others."""
    from pyspark.ml.feature import Bucketizer

    bounds = (df if of is None else of).agg(F.percentile_approx(F.col(value).cast("double"), [k / cells for k in range(1, cells)], 10_000)).first()[0] or []
    splits = [-float("inf"), *sorted({b for b in bounds if b == b and abs(b) != float("inf")} or {0.0}), float("inf")]
    out = Bucketizer(splits=splits, inputCol="_in", outputCol="_out", handleInvalid="keep").transform(df.withColumn("_in", F.col(value).cast("double")))
    return out.withColumn(alias, F.when(F.col("_in").isNull(), -1).otherwise(F.col("_out").cast("int"))).drop("_in", "_out")


def running(df: DataFrame, count: str, order: list[Column | str], alias: str, cell: str = "_cell", inclusive: bool = False) -> DataFrame:
    """df with the sum of count over all rows before each in (cell, order), or up to it. One row of each cell meets in one task."""
    before = Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    start = df.groupBy(cell).agg(F.sum(count).alias("_s")).withColumn("_start", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    inside = Window.partitionBy(cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.join(F.broadcast(start), cell).withColumn(alias, F.col("_start") + F.coalesce(F.sum(count).over(inside), F.lit(0))).drop("_start")


def ranks(df: DataFrame, value: str, alias: str, weight: str | None = None) -> DataFrame:
    """df with the average rank of value over the whole table, a row counting `weight` times; null comes before all.

    The distinct values are ranked cell by cell. A value that has more than a 256th of the rows is one of at most 256,
    so those are sent to all tasks; all others are joined by value, where none has many rows.
    """
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    counts = counts.persist()
    placed = kept(running(in_cells(counts, "_v"), "_n", ["_v"], "_before").select("_v", "_rows", (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(alias)))
    counts.unpersist()
    all_rows = placed.agg(F.sum("_rows")).first()[0] or 0
    common = placed.filter(F.col("_rows") * 256 > all_rows).select("_v", alias)
    same = F.col(value).eqNullSafe(F.col("_v"))
    out = df.join(F.broadcast(common), same, "left").withColumn("_common", F.col(alias).isNotNull()).drop("_v")
    rest = out.filter(~F.col("_common")).drop(alias).join(placed.drop("_rows"), same).select(*df.columns, alias)
    return out.filter("_common").select(*df.columns, alias).unionByName(rest)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: spearman of two columns over the rows where both are present; null without two values on either side.

    Equal pairs of values are summed first; the correlation is of ranks less their mean, weighted by the pairs' rows.
    """
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("_a"), F.col(b).alias("_b"))
    pairs = kept(both.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_w")))
    mean = (F.lit(pairs.agg(F.sum("_w")).first()[0] or 0) + 1) / 2.0
    r = ranks(ranks(pairs, "_a", "_ra", "_w"), "_b", "_rb", "_w")
    x, y, w = F.col("_ra") - mean, F.col("_rb") - mean, F.col("_w")
    return r.agg(F.try_divide(F.sum(w * x * y), F.sqrt(F.sum(w * x * x)) * F.sqrt(F.sum(w * y * y))).alias("spearman"))


#: Cells that the values between two bounds are counted in, and values of a cell from which it is not cut any further.
CELLS, FEW = 4096, 10_000


def order_statistics(df: DataFrame, column: str, places: list[int]) -> dict[int, float]:
    """The values at the given places (from 0) in the order of a column's values that are not null; NaN is last.

    Selection by cells: the values that may stand at a place are counted in even cells between their bounds; of those
    only the cell with the place goes on, with the bounds of its own values, until its values are few or all equal.
    A pass moves one row for each cell and task, and no sort or buffer holds the column.
    """
    v = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    odd = v.agg(F.count_if(F.col("v") == -float("inf")), F.count_if(F.isnan("v")), F.count_if(F.col("v") == float("inf")), F.count(F.lit(1)), F.min(_finite()), F.max(_finite())).first()
    low, nan, high, n, least, most = odd
    out: dict[int, float] = {}
    open_: dict[tuple[float, float], list[tuple[int, int]]] = {}  # bounds -> (place, how many values are below the bounds)
    for k in set(places):
        if not 0 <= k < n:
            raise ValueError(f"there is no place {k} among {n} values")
        if k < low or k >= n - nan - high:
            out[k] = -float("inf") if k < low else float("nan") if k >= n - nan else float("inf")
        else:
            open_.setdefault((least, most), []).append((k, low))
    while open_:
        bounds = sorted(open_)
        for lo, hi in [b for b in bounds if b[0] == b[1]]:
            out.update({k: lo for k, _ in open_.pop((lo, hi))})
        bounds = sorted(open_)
        if not bounds:
            break
        # halves, as the distance of two doubles can be too large for a double
        cell = [F.least(F.floor((F.col("v") / 2 - lo / 2) / ((hi / 2 - lo / 2) / CELLS)), F.lit(CELLS - 1)) for lo, hi in bounds]
        inside = [F.col("v").between(lo, hi) for lo, hi in bounds]
        rows = v.select("v", F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.when(x, c).alias("cell")) for i, (x, c) in enumerate(zip(inside, cell, strict=True))]))).filter("cell is not null")
        found = rows.groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("i", "cell").collect()
        further: dict[tuple[float, float], list[tuple[int, int]]] = {}
        for i, b in enumerate(bounds):
            for k, below in open_[b]:
                for r in (r for r in found if r["i"] == i):
                    if k < below + r["n"]:
                        further.setdefault((r["lo"], r["hi"], r["n"]), []).append((k, below))
                        break
                    below += r["n"]
        open_ = {}
        few = [b for b in further if b[2] <= FEW and b[0] < b[1]]
        near = {}
        if few:
            wanted = F.array(*[F.when(F.col("v").between(lo, hi), F.lit(i)) for i, (lo, hi, _) in enumerate(few)])
            for r in v.select("v", F.explode(wanted).alias("i")).filter("i is not null").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).collect():
                near.setdefault(r["i"], []).append((r["v"], r["n"]))
        for b, asked in further.items():
            if b not in few:
                open_[b[:2]] = asked
                continue
            values = np.array(sorted(near[few.index(b)]))
            ends = np.cumsum(values[:, 1])
            out.update({k: float(values[np.searchsorted(ends, k - below, side="right"), 0]) for k, below in asked})
    return out


def _finite() -> Column:
    return F.when(~F.isnan("v") & (F.abs("v") != float("inf")), F.col("v"))


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """The exact quantiles of a column, between two values by their distance; None for all if it has no values."""
    n = df.agg(F.count(column)).first()[0]
    if not n:
        return [None] * len(shares)
    at = [p * (n - 1) for p in shares]
    found = order_statistics(df, column, [f(x) for x in at for f in (math.floor, math.ceil)])
    ends = [(found[math.floor(x)], found[math.ceil(x)], x - math.floor(x)) for x in at]
    return [lo if lo == hi or not share else lo + (hi - lo) * share for lo, hi, share in ends]


def median_by(df: DataFrame, key: str, column: str, alias: str = "median") -> DataFrame:
    """(key, median) of a column of whole numbers of which a key has few different ones: from their counts, so a key with
    most of all rows is summed like any other."""
    n = df.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(key).orderBy(column)
    n = n.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy(key)))
    at = lambda place: F.min(F.when(F.col("_upto") > place, F.col(column)))
    return n.groupBy(key).agg(((at(F.floor((F.col("_all") - 1) / 2)) + at(F.floor(F.col("_all") / 2))) / 2.0).alias(alias))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, pearson) for all pairs, in one pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("pearson")) for i, (a, b) in enumerate(pairs)])))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, n) of equal bins from the smallest to the largest value, which is in the last bin."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    at = F.least(F.floor((F.col(column) - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)), F.lit(bins - 1))
    x = df.filter(F.col(column).isNotNull()).crossJoin(ends)
    return x.groupBy(F.when(F.col("_hi") > F.col("_lo"), at).otherwise(0).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def kde(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density): Gaussian kernel density on an even grid, with Scott's bandwidth.

    A task adds up its rows' kernels at all points, block by block; its sums are all that is shuffled. Values that are
    all equal, or none, have no density and give no rows.
    """
    prepare(df.sparkSession)
    lo, hi, sd, n = df.agg(F.min(column).cast("double"), F.max(column).cast("double"), F.stddev_samp(column), F.count(column)).first()
    h = (sd or 0.0) * max(n, 1) ** -0.2
    kind = "point int, x double, density double"
    if not h:
        return df.sparkSession.createDataFrame([], kind)
    grid = lo + (hi - lo) * np.arange(points) / (points - 1)

    def run(batches):
        total = np.zeros(points)
        for batch in batches:
            v = batch.column("v").to_numpy(zero_copy_only=False)
            for k in range(0, len(v), 4096):
                z = (grid[:, None] - v[None, k : k + 4096]) / h
                total += np.exp(-0.5 * z * z).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(range(points), pa.int32()), pa.array(grid), pa.array(total / (n * h * 2.5066282746310002))], names=["point", "x", "density"])

    sums = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")).mapInArrow(run, kind)
    return sums.groupBy("point").agg(F.first("x").alias("x"), F.sum("density").alias("density"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std, min, quartiles and max."""
    q = [F.lit(x).cast("double").alias(name) for x, name in zip(quantiles(df, column, [0.25, 0.5, 0.75]), ("q25", "q50", "q75"), strict=True)]
    one = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))
    return one.select("n", "mean", "std", "min", *q, "max")


def weighted_average(df: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """(key, value): sum(value * weight) / sum(weight); a missing value makes the result missing."""
    missing = F.count_if(F.col(value).isNull() | F.col(weight).isNull())
    return df.groupBy(key).agg(F.when(missing == 0, F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))).alias(value))


def rank_change(df: DataFrame, key: str, a: str, b: str, n: int) -> DataFrame:
    """The n keys whose average ranks (largest first) by a and by b differ most: (key, rank_a, rank_b, change)."""
    total = df.count()
    r = ranks(ranks(df.select(key, a, b), a, "_ra"), b, "_rb")
    r = r.select(key, (total + 1 - F.col("_ra")).alias("rank_a"), (total + 1 - F.col("_rb")).alias("rank_b"))
    return r.withColumn("change", F.abs(F.col("rank_a") - F.col("rank_b"))).orderBy(F.desc("change"), key).limit(n)


def confusion(df: DataFrame, truth: str, found: str) -> DataFrame:
    """(truth, found, n)."""
    return df.groupBy(truth, found).agg(F.count(F.lit(1)).alias("n"))
