"""Agreement between runs, on the long form runs(run, ad, code, score): one row for each candidate of an ad in a run.

Metrics compare all pairs of runs (run_a < run_b) over the ads that every run has. A run's candidates are joined once
by (ad, code); unions come from sizes and sums, so no outer join is needed.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.workers import prepare
from ..sources.files import kept
from .stats import average_rank, median_by, quantiles


def _of_all(sizes: DataFrame) -> DataFrame:
    """(ad) of the ads that all runs have. sizes: a written table with a row for each (run, ad)."""
    n = sizes.select("run").distinct().count()
    return sizes.groupBy("ad").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == n).select("ad")


def common(runs: DataFrame) -> DataFrame:
    """The rows of ads that all runs have."""
    return runs.join(_of_all(kept(runs.groupBy("run", "ad").agg(F.count(F.lit(1)).alias("_rows")))), "ad", "left_semi")


def _two(df: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Every pair of runs that meets in `on`, with columns as <name>_a and <name>_b.

    One aggregation by `on` and no self-join: a list has as many entries as there are runs at most.
    """
    g = df.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("run", *columns))).alias("_r"))
    row = lambda x, y: F.struct(x["run"].alias("run_a"), y["run"].alias("run_b"), *[v[c].alias(f"{c}_{s}") for s, v in (("a", x), ("b", y)) for c in columns])
    later = lambda x: F.filter("_r", lambda y: y["run"] > x["run"])
    return g.select(*on, F.inline(F.flatten(F.transform("_r", lambda x: F.transform(later(x), lambda y: row(x, y))))))


def _sums(runs: DataFrame, columns: list[str], own: dict, shared: dict) -> tuple[DataFrame, DataFrame]:
    """Over the common ads: (run, ad, own sums of a run's candidates) and (run_a, run_b, ad, sums over shared candidates).

    own: name -> expression of a candidate; shared: name -> expression of a candidate in two runs. A candidate's rows
    meet once, in a list of as many entries as there are runs; what leaves it is summed before it is moved by ad.
    """
    g = runs.groupBy("ad", "code").agg(F.collect_list(F.struct("run", *columns)).alias("_r"))
    zero = F.lit(0.0)

    def entry(x, y):
        same = x["run"] == y["run"]
        sums = [F.when(same, e(x)).otherwise(zero).alias(n) for n, e in own.items()] + [F.when(same, zero).otherwise(e(x, y)).alias(n) for n, e in shared.items()]
        return F.struct(x["run"].alias("run_a"), y["run"].alias("run_b"), *sums)

    pairs = g.select("ad", F.inline(F.flatten(F.transform("_r", lambda x: F.transform(F.filter("_r", lambda y: y["run"] >= x["run"]), lambda y: entry(x, y))))))
    sums = kept(pairs.groupBy("ad", "run_a", "run_b").agg(*[F.sum(n).alias(n) for n in (*own, *shared)]))
    alone = sums.filter("run_a = run_b").select(F.col("run_a").alias("run"), "ad", *own)
    ads = _of_all(alone)
    return alone.join(ads, "ad", "left_semi"), sums.filter("run_a < run_b").select("run_a", "run_b", "ad", *shared)


def overlaps(runs: DataFrame) -> DataFrame:
    """(run_a, run_b, ad, shared, size_a, size_b) for the common ads."""
    alone, both = _sums(runs, [], {"size": lambda x: F.lit(1.0)}, {"shared": lambda x, y: F.lit(1.0)})
    whole = lambda c: F.coalesce(F.col(c), F.lit(0.0)).cast("long").alias(c)
    out = _two(alone, ["ad"], ["size"]).join(both, ["run_a", "run_b", "ad"], "left")
    return out.select("run_a", "run_b", "ad", *[whole(c) for c in ("shared", "size_a", "size_b")])


def jaccard(runs: DataFrame) -> DataFrame:
    union = F.col("size_a") + F.col("size_b") - F.col("shared")
    return overlaps(runs).groupBy("run_a", "run_b").agg(F.avg(F.col("shared") / union).alias("jaccard"))


def at_least(runs: DataFrame, n: int) -> DataFrame:
    """Share of ads with an overlap of at least n, or of all where a side has fewer."""
    enough = F.col("shared") >= F.least(F.lit(n), "size_a", "size_b")
    return overlaps(runs).groupBy("run_a", "run_b").agg(F.avg(enough.cast("double")).alias("at_least"))


def _ruzicka(c: DataFrame) -> DataFrame:
    """Mean over the common ads of sum(min) / sum(max), a candidate that a run lacks being 0."""
    low = lambda x: F.least(x["score"], F.lit(0.0))
    alone, both = _sums(c, ["score"], {"total": lambda x: x["score"], "low": low}, {"gain": lambda x, y: F.least(x["score"], y["score"]) - low(x) - low(y)})
    s = _two(alone, ["ad"], ["total", "low"]).join(both, ["run_a", "run_b", "ad"], "left")
    s = s.withColumn("inter", F.coalesce("gain", F.lit(0.0)) + F.col("low_a") + F.col("low_b"))
    union = F.col("total_a") + F.col("total_b") - F.col("inter")
    return s.groupBy("run_a", "run_b").agg(F.avg(F.when(union > 0, F.col("inter") / union).otherwise(0.0)).alias("ruzicka"))


def ruzicka(runs: DataFrame) -> DataFrame:
    """Weighted Jaccard of scores scaled to sum 1 in each ad and run, negative ones being 0."""
    c = runs.withColumn("score", F.greatest("score", F.lit(0.0)))
    total = F.sum("score").over(Window.partitionBy("run", "ad"))
    return _ruzicka(c.withColumn("score", F.when(total > 0, F.col("score") / total).otherwise(F.col("score"))))


def raw_ruzicka(runs: DataFrame) -> DataFrame:
    return _ruzicka(runs)


def softmax_ruzicka(runs: DataFrame, temperature: float = 1.0) -> DataFrame:
    w = Window.partitionBy("run", "ad")
    e = F.exp((F.col("score") - F.max("score").over(w)) / temperature)
    c = runs.withColumn("e", e)
    return _ruzicka(c.withColumn("score", F.col("e") / F.sum("e").over(w)).drop("e"))


def spearman(runs: DataFrame) -> DataFrame:
    """Mean over ads of the rank correlation on shared candidates: at least three, and two values on either side."""
    keys = ["run_a", "run_b", "ad"]
    p = _two(common(runs), ["ad", "code"], ["score"])
    p = p.withColumn("ra", average_rank("score_a", *keys)).withColumn("rb", average_rank("score_b", *keys))
    per = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("score_a").alias("la"), F.max("score_a").alias("ha"), F.min("score_b").alias("lb"), F.max("score_b").alias("hb"), F.corr("ra", "rb").alias("rho"))
    good = per.filter("n >= 3 and la < ha and lb < hb and rho is not null and not isnan(rho)")
    return good.groupBy("run_a", "run_b").agg(F.avg("rho").alias("spearman"))


def best(runs: DataFrame) -> DataFrame:
    """(run, ad, top1): the candidate with the largest score, ties by code."""
    order = Window.partitionBy("run", "ad").orderBy(F.desc("score"), "code")
    return runs.withColumn("rn", F.row_number().over(order)).filter("rn <= 1").select("run", "ad", F.col("code").alias("top1"))


def top1(tops: DataFrame, ads: DataFrame) -> DataFrame:
    """Share of ads with the same best candidate; an ad that both runs lack counts as agreement.

    tops: (run, ad, top1); ads: (ad). All pairs of the runs in tops.
    """
    names = tops.select("run").distinct()
    full = ads.crossJoin(names).join(tops, ["ad", "run"], "left")
    return _two(full, ["ad"], ["top1"]).groupBy("run_a", "run_b").agg(F.avg(F.col("top1_a").eqNullSafe(F.col("top1_b")).cast("double")).alias("top1"))


def matrix_summary(pairs: DataFrame, value: str) -> DataFrame:
    """One row over the upper triangle: mean, median, min, max, population std."""
    median = F.lit(quantiles(pairs, value, [0.5])[0]).cast("double")
    return pairs.agg(F.avg(value).alias("mean"), F.max(median).alias("median"), F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_pop(value).alias("std"))


def full_matrix(pairs: DataFrame, value: str) -> DataFrame:
    """(run_a, run_b, value) with both triangles and 1 on the diagonal."""
    names = pairs.select(F.col("run_a").alias("r")).union(pairs.select("run_b")).distinct()
    upper = pairs.select("run_a", "run_b", value)
    return upper.union(pairs.select(F.col("run_b"), F.col("run_a"), value)).union(names.select("r", "r", F.lit(1.0)))


#: Decisions about the first runs that a task of the search for best subsets starts from, as a power of two of tasks.
PREFIX = 4


def _climbed(w: np.ndarray, k: int) -> float:
    """The sum of a good subset of k runs: greedy from each run, then exchanges while they gain."""
    found = -np.inf
    for first in range(len(w)):
        s = [first]
        while len(s) < k:
            gain = w[:, s].sum(1)
            gain[s] = -np.inf
            s.append(int(gain.argmax()))
        while len(s) < len(w):
            gain = w[:, s].sum(1)
            out = np.setdiff1d(np.arange(len(w)), s)
            better = gain[out] - gain[s][:, None] - w[np.ix_(s, out)]
            i, j = np.unravel_index(better.argmax(), better.shape)
            if better[i, j] <= 1e-12:
                break
            s[i] = int(out[j])
        found = max(found, w[np.ix_(s, s)].sum() / 2)
    return found


def _best_subset(w: np.ndarray, k: int, prefix: list[bool]) -> tuple[float, list[int]] | None:
    """The largest sum of pairs of k runs, and the first such subset, among those that take and leave the first runs as
    prefix says; None if it is less than a subset that is found by climbing.

    Branch and bound in the runs' order: what can still be added is at most the sum of the largest values that single
    runs add, each with half of its largest pair values among the runs left.
    """
    least, n, best = _climbed(w, k) - 1e-9, len(w), None

    def search(i: int, taken: list[int], total: float, gain: np.ndarray) -> None:
        nonlocal best
        r = k - len(taken)
        if r == 0:
            if i >= len(prefix) or not any(prefix[i:]):
                if best is None and total >= least or best is not None and total > best[0] + 1e-12:
                    best = (total, taken)
            return
        if n - i < r:
            return
        pairs = np.sort(w[i:, i:], axis=1)[:, ::-1][:, : r - 1].sum(1)
        bound = total + np.sort(gain[i:] + pairs / 2)[::-1][:r].sum()
        if bound < least if best is None else bound <= best[0] + 1e-12:
            return
        if i >= len(prefix) or prefix[i]:
            search(i + 1, [*taken, i], total + gain[i], gain + w[i])
        if i >= len(prefix) or not prefix[i]:
            search(i + 1, taken, total, gain)

    search(0, [], 0.0, np.zeros(n))
    return best


def subsets(pairs: DataFrame, value: str) -> DataFrame:
    """(size, mean, runs) of the subset of each size with the largest mean of pairs; of equal ones the first.

    pairs: (run_a, run_b, value) for all pairs of the runs, run_a < run_b; a value that lacks counts as 0. Exact for any
    number of runs: a task has a size and the decisions about the first runs, and searches what is left by branch and
    bound. The matrix of the runs goes to the tasks as one row. A second over 40 runs that differ; the time is not
    bounded where dozens of runs are alike but for noise.
    """
    prepare(pairs.sparkSession)
    matrix = pairs.agg(F.array_sort(F.collect_list(F.struct("run_a", "run_b", F.col(value).cast("double").alias("v")))).alias("pairs"))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["run_a"], p["run_b"])))))
    matrix = matrix.withColumn("names", names).filter(F.size("names") > 1)
    tasks = matrix.withColumn("size", F.explode(F.sequence(F.lit(2), F.size("names")))).withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit((1 << PREFIX) - 1))))
    tasks = tasks.repartition(2 * pairs.sparkSession.sparkContext.defaultParallelism, "size", "prefix")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names = row["names"]
                at = {x: i for i, x in enumerate(names)}
                w = np.zeros((len(names), len(names)))
                for p in row["pairs"]:
                    w[at[p["run_a"]], at[p["run_b"]]] = w[at[p["run_b"]], at[p["run_a"]]] = p["v"] or 0.0
                prefix = [bool(row["prefix"] >> i & 1) for i in range(PREFIX)]
                if any(prefix[len(names) :]):
                    continue
                k = row["size"]
                found = _best_subset(w, k, prefix[: len(names)])
                if found:
                    chosen = [names[i] for i in found[1]]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([found[0] / (k * (k - 1) / 2)]), pa.array([chosen], pa.list_(pa.string()))], names=["size", "mean", "runs"])

    found = tasks.mapInArrow(run, "size int, mean double, runs array<string>")
    first = Window.partitionBy("size").orderBy(F.desc(F.round("mean", 11)), "runs")
    return found.withColumn("rn", F.row_number().over(first)).filter("rn <= 1").drop("rn")


def best_subsets(pairs: DataFrame, value: str) -> list[tuple[int, float, list[str]]]:
    """(size, mean, runs) of the subset of each size with the largest mean of pairs, sizes falling: see subsets."""
    return [(r["size"], r["mean"], r["runs"]) for r in subsets(pairs, value).orderBy(F.desc("size")).collect()]


def selectivity(runs: DataFrame) -> DataFrame:
    """(run, mean_candidates, median_candidates): candidates for each ad, to one place and as a whole number."""
    n = runs.groupBy("run", "ad").agg(F.count(F.lit(1)).alias("n"))
    medians = median_by(n, "run", "n").select("run", F.col("median").cast("int").alias("median_candidates"))
    return n.groupBy("run").agg(F.round(F.avg("n"), 1).alias("mean_candidates")).join(medians, "run")


def majority(runs: DataFrame) -> DataFrame:
    """(ad, code) that more than half of the runs have."""
    n = runs.select("run").distinct().count()
    return runs.groupBy("ad", "code").agg(F.count_distinct("run").alias("votes")).filter(F.col("votes") > n / 2).select("ad", "code")


def against_majority(runs: DataFrame) -> DataFrame:
    """(run, precision, recall, f1) of each run against the majority set, over all candidates together.

    Candidates that the same runs have are counted together, so the runs are read once and what is left is small.
    """
    sets = runs.groupBy("ad", "code").agg(F.array_sort(F.collect_set("run")).alias("_runs")).groupBy("_runs").agg(F.count(F.lit(1)).alias("n"))
    sets = kept(sets)
    names = sets.select(F.explode("_runs")).distinct().count()
    both = F.when(F.size("_runs") > names / 2, F.col("n")).otherwise(0)
    hits = sets.withColumn("m", both).select(F.explode("_runs").alias("run"), "n", "m").groupBy("run").agg(F.sum("m").alias("tp"), F.sum("n").alias("n"))
    x = hits.crossJoin(sets.agg(F.sum(both).alias("all")))
    p, r = F.try_divide(F.col("tp"), F.col("n")), F.try_divide(F.col("tp"), F.col("all"))
    return x.select("run", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def vectors(scores: DataFrame, group: Column | None = None, least: int = 2) -> DataFrame:
    """(run_a, run_b[, group], n, pearson, mad) of runs' ad scores (run, ad, value), in groups of at least `least` ads."""
    keys = ["run_a", "run_b"] + (["group"] if "group" in scores.columns else [])
    p = _two(scores.drop("group") if "group" in scores.columns else scores, ["ad"], ["value"])
    if "group" in scores.columns:
        p = p.join(scores.select("ad", "group").distinct(), "ad")
    return p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.corr("value_a", "value_b").alias("pearson"), F.avg(F.abs(F.col("value_a") - F.col("value_b"))).alias("mad")).filter(F.col("n") >= least)


def leave_one_out(scores: DataFrame, least: int = 50) -> DataFrame:
    """(run_a, run_b, group, delta): the correlation over all ads less that without a group, from sums of each group.

    scores: (run, ad, group, value); at least `least` ads must be left.
    """
    p = _two(scores.drop("group"), ["ad"], ["value"]).join(scores.select("ad", "group").distinct(), "ad")
    a, b = F.col("value_a"), F.col("value_b")
    sums = {"n": F.count(F.lit(1)), "sa": F.sum(a), "sb": F.sum(b), "saa": F.sum(a * a), "sbb": F.sum(b * b), "sab": F.sum(a * b)}
    per = p.groupBy("run_a", "run_b", "group").agg(*[v.alias(k) for k, v in sums.items()])
    whole = Window.partitionBy("run_a", "run_b")

    def corr(f):
        n, sa, sb, saa, sbb, sab = (f(k) for k in sums)
        return F.try_divide(n * sab - sa * sb, F.sqrt((n * saa - sa * sa) * (n * sbb - sb * sb)))

    per = per.select("run_a", "run_b", "group", *sums, *[F.sum(k).over(whole).alias(f"all_{k}") for k in sums])
    out = per.withColumn("delta", corr(lambda k: F.col(f"all_{k}")) - corr(lambda k: F.col(f"all_{k}") - F.col(k)))
    return out.filter(F.col("all_n") - F.col("n") >= least).select("run_a", "run_b", "group", "delta")


def arms(runs: DataFrame, fixed: dict[str, list[str]] | None = None) -> DataFrame:
    """(arm, fixed, run): groups of at least two runs that share two of their three models and differ in the third.

    runs: (run) named val__definition__llm__embedding__reranker. fixed: the models of each kind that may be shared; any
    where it is not given.
    """
    s = runs.select("run", F.split("run", "__").alias("p")).filter((F.size("p") == 5) & (F.col("p")[0] == "val"))
    s = s.select("run", F.col("p")[2].alias("llm"), F.col("p")[3].alias("embedding"), F.col("p")[4].alias("reranker"))
    parts = {"llm": ("embedding", "reranker"), "embedding": ("llm", "reranker"), "reranker": ("llm", "embedding")}
    able = lambda kinds: F.lit(True) if fixed is None else F.forall(F.array(*[F.col(k).isin(*fixed[k]) for k in kinds]), lambda x: x)
    long = s.select("run", F.inline(F.array(*[F.struct(F.lit(arm).alias("arm"), F.concat_ws(" + ", *kinds).alias("fixed"), able(kinds).alias("able")) for arm, kinds in parts.items()]))).filter("able").drop("able")
    return long.join(long.groupBy("arm", "fixed").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select("arm", "fixed"), ["arm", "fixed"])


def shared_fraction(runs: DataFrame) -> DataFrame:
    """(run_a, run_b, shared_fraction): mean Jaccard over the ads that either run has; 0 where one has none."""
    sizes = runs.groupBy("run", "ad").agg(F.count(F.lit(1)).alias("size"))
    names = runs.select("run").distinct()
    pairs = names.select(F.col("run").alias("run_a")).join(names.select(F.col("run").alias("run_b")), F.col("run_a") < F.col("run_b"))
    either = sizes.join(pairs, (F.col("run") == F.col("run_a")) | (F.col("run") == F.col("run_b"))).groupBy("run_a", "run_b", "ad").agg(F.sum("size").alias("total"))
    shared = _two(runs, ["ad", "code"], []).groupBy("run_a", "run_b", "ad").agg(F.count(F.lit(1)).alias("shared"))
    x = either.join(shared, ["run_a", "run_b", "ad"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
    return x.groupBy("run_a", "run_b").agg(F.avg(F.col("shared") / (F.col("total") - F.col("shared"))).alias("shared_fraction"))


def head_to_head(first: DataFrame, second: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row: wins of each side and ties, by the best rating that a ranking has for each ad that both rank.

    first, second: (ad, code); ratings: (ad, code, rating).
    """
    best = lambda df, name: df.join(ratings, ["ad", "code"]).groupBy("ad").agg(F.max("rating").alias(name))
    x = best(first, "a").join(best(second, "b"), "ad")
    return x.agg(F.count_if(F.col("a") > F.col("b")).alias("wins_a"), F.count_if(F.col("a") < F.col("b")).alias("wins_b"), F.count_if(F.col("a") == F.col("b")).alias("ties"))


def rating_distribution(rankings: dict[str, DataFrame], ratings: DataFrame) -> DataFrame:
    """(ranking, rating, n, share): how often each rating comes up in each ranking (ad, code), and its share there."""
    long = reduce(DataFrame.unionByName, [r.select(F.lit(name).alias("ranking"), "ad", "code") for name, r in rankings.items()])
    n = long.join(ratings, ["ad", "code"]).groupBy("ranking", "rating").agg(F.count(F.lit(1)).alias("n"))
    return n.join(n.groupBy("ranking").agg(F.sum("n").alias("all")), "ranking").select("ranking", "rating", "n", (F.col("n") / F.col("all")).alias("share"))


def variant_agreement(runs: DataFrame, reference: str, k: int, group: Column) -> DataFrame:
    """(run, top1, topk, group_agreement) of each other run against the reference, over the common ads.

    topk: share of ads whose k best are the same set; group: of a code.
    """
    order = Window.partitionBy("run", "ad").orderBy(F.desc("score"), "code")
    t = common(runs).withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)
    s = t.groupBy("run", "ad").agg(F.min_by("code", "rn").alias("top"), F.array_sort(F.collect_list("code")).alias("set")).withColumn("group", group)
    r = s.filter(F.col("run") == reference).select("ad", F.col("top").alias("rt"), F.col("set").alias("rs"), F.col("group").alias("rg"))
    share = lambda c: F.avg(c.cast("double"))
    return s.filter(F.col("run") != reference).join(r, "ad").groupBy("run").agg(share(F.col("top") == F.col("rt")).alias("top1"), share(F.col("set") == F.col("rs")).alias("topk"), share(F.col("group") == F.col("rg")).alias("group_agreement"))


def pruned_subset(pairs: DataFrame, value: str) -> tuple[float, list[str]]:
    """How much the best subset of two thirds of the runs (rounded up) gains on all of them, and who is left out of it."""
    found = best_subsets(pairs, value)
    n = found[0][0]
    kept_ = next(s for s in found if s[0] == max(2, -(-2 * n // 3)))
    return kept_[1] - found[0][1], sorted(set(found[0][2]) - set(kept_[2]))
