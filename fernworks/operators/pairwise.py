"""Pairwise comparisons: which pairs to ask, the Bradley-Terry fit, and scores from it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.workers import prepare
from ..sources.files import kept
from .exposure import minmax
from .stats import in_cells, running


#: Pairs up to which a fit is solved on the driver, which holds some 200 bytes of each at once.
DRIVER_PAIRS = 500_000
#: Largest part of the gradient, in wins, that is left at a solution, whichever way it was found.
GRADIENT = 1e-6


def shuffled_pairs(items: DataFrame, rounds: int, seed: int = 0, key: str = "item") -> DataFrame:
    """(a, b), a < b: in each round the items in hash order, neighbours paired; a pair counts once over all rounds.

    Places in the hash order are found by buckets (the number of items in the buckets before, and the place inside),
    so a round is not sorted in one task.
    """
    i = items.select(F.col(key).alias("item")).distinct().withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    h = F.md5(F.concat_ws("-", F.col("item").cast("string"), F.col("round").cast("string"), F.lit(str(seed))).cast("binary"))
    i = i.withColumn("h", h).withColumn("bucket", F.substring("h", 1, 3))
    before = Window.partitionBy("round").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = i.groupBy("round", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.col("start") + F.row_number().over(Window.partitionBy("round", "bucket").orderBy("h", "item")) - 1
    p = i.join(start, ["round", "bucket"]).withColumn("pair", F.floor(place / 2))
    two = p.groupBy("round", "pair").agg(F.min("item").alias("a"), F.max("item").alias("b"), F.count(F.lit(1)).alias("n"))
    return two.filter("n = 2").select("a", "b").distinct()


#: About how many items of one value are in a block. Spark holds the pairs of two blocks at once, before they go on.
BLOCK_ITEMS = 256


def band_pairs(items: DataFrame, value: str, width: float, key: str = "item") -> DataFrame:
    """(a, b), a < b, of items whose values differ by at most width: an equi-join of blocks on cells of that width.

    Items of one value are in the same pairs of values, so they are put into blocks first, a common value into several by
    a hash of the item; its number of blocks is sent to all tasks, a row for at least BLOCK_ITEMS items. Blocks of values
    within the width are met with each other once, dealt anew, and written out as pairs of items: the result grows with
    the square of the items in a width, what is joined and moved only with that of the blocks. A task holds two blocks.
    """
    t = items.select(F.col(key).alias("a"), F.col(value).alias("x")).filter(F.abs("x") < float("inf"))
    often = t.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ITEMS).alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1)))
    blocks = t.join(F.broadcast(often), "x", "left").groupBy("x", part.alias("part")).agg(F.collect_list("a").alias("items"))
    cell = F.floor(F.greatest(F.least(F.col("x") / width, F.lit(4e18)), F.lit(-4e18)))
    side = lambda s, cell: blocks.select(F.col("x").alias(f"x{s}"), F.col("part").alias(f"part{s}"), F.col("items").alias(f"items{s}"), cell.alias("cell"))
    # a quotient may be rounded up to the cell after the next
    met = side(1, F.explode(F.array(cell, cell + 1, cell + 2))).join(side(2, cell), "cell").filter(F.abs(F.col("x1") - F.col("x2")) <= width)
    met = met.filter((F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("part1") <= F.col("part2"))))
    same = (F.col("x1") == F.col("x2")) & (F.col("part1") == F.col("part2"))
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, so that small files of large results are not put together
    met = met.withColumn("same", same).select("same", "items1", "items2").repartition(tasks)
    pairs = met.withColumn("u", F.explode("items1")).withColumn("v", F.explode("items2")).filter((F.col("u") < F.col("v")) | (~F.col("same") & (F.col("u") > F.col("v"))))
    return pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))


def _priority(seed: int):
    return F.substring(F.md5(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"), F.lit(str(seed))).cast("binary")), 1, 12)


#: Rounds of a matching between two written tables.
MATCHING_ROUNDS = 3


def matched(edges: DataFrame, capacity: int, seed: int = 0) -> DataFrame:
    """(a, b) of the edges that are taken when they come up in the order of a hash and both ends have room: an item is in
    at most `capacity` of them, and an edge that is not taken has an end without room.

    edges: (a, b), a < b, each once. An edge that is among the first `capacity` at both of its ends is taken whatever
    becomes of the others, so many are taken in one round and the result is that of taking one after another. A round is
    a window by item and a sum by edge; what remains is written every MATCHING_ROUNDS rounds, of which there are about
    as many as the logarithm of the edges.
    """
    left = kept(edges.select("a", "b", _priority(seed).alias("order"), F.lit(False).alias("taken")))
    item = Window.partitionBy("item")
    while True:
        for _ in range(MATCHING_ROUNDS):
            ends = left.withColumn("item", F.explode(F.array("a", "b")))
            ends = ends.withColumn("place", F.row_number().over(item.orderBy(F.desc("taken"), "order", "a", "b"))).withColumn("full", F.count_if("taken").over(item) >= capacity)
            met = ends.groupBy("a", "b", "order", "taken").agg(F.max("place").alias("place"), F.bool_or("full").alias("full"))
            left = met.filter(F.col("taken") | ~F.col("full")).select("a", "b", "order", (F.col("place") <= capacity).alias("taken"))
        left = kept(left)
        if not left.filter(~F.col("taken")).limit(1).count():
            return left.select("a", "b")


def band_partners(items: DataFrame, value: str, width: float, k: int, key: str = "item") -> DataFrame:
    """(a, b, apart): the k items nearest to each by value, of those within width of it; of equally near ones the smaller.

    Items are numbered in the order of (value, item), and joined with those up to k places before and after, of which
    they can only be; where more than k have the same value as an item, its k are among those next to it in that order.
    So 2k rows of an item are made, however many others the width holds.
    """
    t = items.select(F.col(key).alias("a"), F.col(value).cast("double").alias("x")).filter("x is not null and not isnan(x)").withColumn("_one", F.lit(1))
    of = kept(running(in_cells(t, "x"), "_one", ["x", "a"], "place").select("a", "x", "place"))
    steps = F.array(*[F.lit(j) for j in range(-k, k + 1) if j])
    near = of.withColumn("_step", F.explode(steps)).withColumn("at", F.col("place") + F.col("_step")).join(of.select(F.col("a").alias("b"), F.col("x").alias("y"), F.col("place").alias("at")), "at")
    near = near.withColumn("apart", F.abs(F.col("x") - F.col("y"))).filter(F.col("apart") <= width)
    place = F.row_number().over(Window.partitionBy("a").orderBy("apart", "b"))
    return near.withColumn("rn", place).filter(F.col("rn") <= k).select("a", "b", "apart")


def adaptive_pairs(theta: DataFrame, each: int, seed: int = 0, width: float | None = None, spare: int = 4) -> DataFrame:
    """(a, b), a < b: pairs of items of nearly equal strength, at random, each item in `each` of them; random ones besides
    for items with too few others near them.

    theta: (item, theta). width: one (population) standard deviation unless given. The items within the width of one are
    an interval of the order by (theta, item); of its other m items, those at (h + j * (m div c)) mod m are candidates,
    j under c = each * spare, h being a hash of the item and seed. Candidates are matched with a counter on both sides
    (see matched), so an item stops being asked about once others have chosen it. An item whose candidates all have no
    room left, while it still lacks some, gets the first of them nevertheless; so do items with under `each` others
    within the width get partners whatever their counters say. Only such partners are in more pairs than `each`.
    """
    if width is None:
        width = theta.agg(F.stddev_pop("theta")).first()[0] or 0.0
    if width < 1e-6:
        return shuffled_pairs(theta, each, seed)
    t = theta.select("item", F.col("theta").cast("double").alias("theta"))
    ends = lambda v, kind: t.select("item", v.alias("v"), F.lit(kind).alias("kind"), F.lit(0 if kind != 1 else 1).alias("one"))
    points = ends(F.col("theta") - width, 0).unionByName(ends(F.col("theta"), 1)).unionByName(ends(F.col("theta") + width, 2))
    placed = running(in_cells(points, "v"), "one", ["v", "kind", "item"], "place")  # items before the point: at its lower end, at itself, up to its upper end
    of = kept(placed.groupBy("item").pivot("kind", [0, 1, 2]).agg(F.first("place")).select("item", F.col("0").alias("low"), F.col("1").alias("own"), F.col("2").alias("high")))
    m, tries = F.col("high") - F.col("low") - 1, each * spare
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col("item").cast("string"), F.lit(str(seed))).cast("binary")), 1, 12), 16, 10).cast("long")
    asked = of.withColumn("m", m).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(tries - 1)))).filter("j < m")
    at = F.col("low") + F.pmod(h + F.col("j") * F.greatest(F.expr(f"m div {tries}"), F.lit(1)), F.col("m"))
    asked = asked.withColumn("at", F.when(at >= F.col("own"), at + 1).otherwise(at))
    near = asked.select(F.col("item").alias("x"), "at").join(of.select(F.col("item").alias("y"), F.col("own").alias("at")), "at")
    near = near.select("x", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    chosen = matched(near.select("a", "b").distinct(), each, seed)
    counts = chosen.select(F.explode(F.array("a", "b")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    lack = of.filter(m >= each).select(F.col("item").alias("x")).join(counts, "x", "left").select("x", (each - F.coalesce("n", F.lit(0))).alias("lack")).filter("lack > 0").hint("merge")  # as many as a part of the items
    first = F.row_number().over(Window.partitionBy("x").orderBy(_priority(seed), "a", "b"))
    chosen = chosen.union(near.join(lack, "x").join(chosen, ["a", "b"], "left_anti").withColumn("place", first).filter("place <= lack").select("a", "b")).distinct()
    few = of.filter(m < each).select("item")
    if not few.limit(1).count():
        return chosen
    more = shuffled_pairs(theta, 2 * each, seed + 1)
    fallback = more.join(few.select(F.col("item").alias("a")), "a", "left_semi").select("a", "b").union(more.join(few.select(F.col("item").alias("b")), "b", "left_semi").select("a", "b"))
    return chosen.union(fallback).distinct()


def swapped(pairs: DataFrame, seed: int = 0) -> DataFrame:
    """pairs with `swap`, and shown_a, shown_b: half of them are shown the other way round, by hash."""
    swap = F.substring(F.md5(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"), F.lit(str(seed))).cast("binary")), 1, 1) >= "8"
    return pairs.withColumn("swap", swap).withColumn("shown_a", F.when(F.col("swap"), F.col("b")).otherwise(F.col("a"))).withColumn("shown_b", F.when(F.col("swap"), F.col("a")).otherwise(F.col("b")))


def unswapped(outcomes: DataFrame) -> DataFrame:
    """outcome put back for pairs that were shown the other way round; a tie stays a tie."""
    flip = F.when(F.col("outcome") == "A", "B").when(F.col("outcome") == "B", "A").otherwise(F.col("outcome"))
    return outcomes.withColumn("outcome", F.when(F.col("swap"), flip).otherwise(F.col("outcome")))


def collapsed(comparisons: DataFrame) -> DataFrame:
    """(a, b, wins_a, wins_b) of each unordered pair, a tie being half a win for both."""
    first = F.col("a") <= F.col("b")
    win = F.when(F.col("outcome") == "A", 1.0).when(F.col("outcome") == "B", 0.0).when(F.col("outcome") == "tie", 0.5)
    c = comparisons.withColumn("w", F.when(first, win).otherwise(1 - win)).filter("w is not null and a != b")
    return c.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("wins_a"), F.sum(1 - F.col("w")).alias("wins_b"))


def solve(a: np.ndarray, b: np.ndarray, wins_a: np.ndarray, wins_b: np.ndarray, n: int, penalty: float = 1e-4) -> np.ndarray:
    """Strengths with mean 0 that maximise the penalised likelihood: Newton steps solved by conjugate gradients.

    Edges stay a list, so that memory grows with the pairs and not with the square of the items.
    """
    theta, total = np.zeros(n), wins_a + wins_b
    dot = lambda x, y: float(np.einsum("i,i->", x, y))  # noqa: E731  in one thread: waiting for others costs more than it gains

    def loss(t):
        d = t[a] - t[b]
        return float(np.sum(wins_a * np.logaddexp(0, -d) + wins_b * np.logaddexp(0, d)) + 0.5 * penalty * dot(t, t))

    def spread(x):
        return np.bincount(a, x, n) - np.bincount(b, x, n)

    for _ in range(200):
        p = 1 / (1 + np.exp(-(theta[a] - theta[b])))
        g = -spread(wins_a - total * p) + penalty * theta
        if np.abs(g).max(initial=0) < GRADIENT / 1000:
            break
        w = total * p * (1 - p)
        diagonal = np.bincount(a, w, n) + np.bincount(b, w, n) + penalty
        x, r = np.zeros(n), -g
        z = r / diagonal
        d, rz = z, dot(r, z)
        for _ in range(min(n, 500)):
            h = spread(w * (d[a] - d[b])) + penalty * d
            step = rz / dot(d, h)
            x, r = x + step * d, r - step * h
            if dot(r, r) < 1e-20 * max(1.0, dot(g, g)):
                break
            z = r / diagonal
            new = dot(r, z)
            d, rz = z + new / rz * d, new
        size, now = 1.0, loss(theta)
        while size > 1e-8 and loss(theta + size * x) > now + 1e-4 * size * dot(g, x):
            size /= 2
        theta = theta + size * x
    p = 1 / (1 + np.exp(-(theta[a] - theta[b])))
    _settled(-spread(wins_a - total * p) + penalty * theta)
    return theta - theta.mean()


def _settled(gradient: np.ndarray) -> None:
    if np.abs(gradient).max(initial=0) > GRADIENT:
        raise RuntimeError(f"the fit has not settled: {np.abs(gradient).max():.1e} wins are left in the gradient")


#: Pairs of a pack, about how many (each from both sides) there are in a block of items, and its most items: what a task
#: sends back of a block are some hundred KB.
PACK, BLOCK, BLOCK_SIZE = 1 << 16, 1_000_000, 1 << 16


def _packed(edges: DataFrame, n: int) -> DataFrame:
    """(first, size, i, j, w, t, unit) of packs of pairs as arrays in bytes: items from first to first + size, i (from first
    on) with opponent j, i's wins and both ones' wins, counted in bytes as multiples of unit where they are whole or half
    (unit 0.5), else as doubles (1). A pair is there from both sides, so a sum by item is a sum inside a block."""
    blocks = max(1, min(n, max(edges.sparkSession.sparkContext.defaultParallelism, -(-2 * edges.count() // BLOCK), -(-n // BLOCK_SIZE))))
    size = -(-n // blocks)
    total = F.col("wins_a") + F.col("wins_b")
    side = lambda i, j, w: edges.select(F.col(i).alias("i"), F.col(j).alias("j"), F.col(w).alias("w"), total.alias("t"))
    both = side("ia", "ib", "wins_a").unionByName(side("ib", "ia", "wins_b"))

    def pack(rows):
        i, j, w, t = (np.concatenate([b.column(c).to_numpy() for b in rows]) for c in ("i", "j", "w", "t"))
        first = int(i[0]) // size * size
        short = [(2 * x).astype(np.uint8) if ((x >= 0) & (x < 128)).all() else x for x in (w, t)]
        halves = all(x.dtype == np.uint8 and (x == 2 * y).all() for x, y in zip(short, (w, t), strict=True))
        parts = [(i - first).astype(np.int32), j.astype(np.int32), *(short if halves else (w, t))]
        return pa.RecordBatch.from_arrays([pa.array([first]), pa.array([min(size, n - first)]), *(pa.array([x.tobytes()], pa.binary()) for x in parts), pa.array([0.5 if halves else 1.0])], names=["first", "size", "i", "j", "w", "t", "unit"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for s in range(0, batch.num_rows, PACK):
                held.append(batch.slice(s, PACK))
                rows += held[-1].num_rows
                if rows >= PACK:
                    yield pack(held)
                    held, rows = [], 0
        if rows:
            yield pack(held)

    return both.repartitionById(blocks, F.floor(F.col("i") / size).cast("int")).mapInArrow(run, "first long, size long, i binary, j binary, w binary, t binary, unit double")


def _unpacked(batch, k: int):
    """(first, size, i, j, w or None, t) of a pack."""
    first, size, unit = (batch.column(c)[k].as_py() for c in ("first", "size", "unit"))
    raw = lambda c, kind: np.frombuffer(batch.column(c)[k].as_buffer(), kind)
    count = lambda c: raw(c, np.uint8) * 0.5 if unit == 0.5 else raw(c, float)
    return first, size, raw("i", np.int32), raw("j", np.int32), count("w") if "w" in batch.schema.names else None, count("t")


def _weight(t, d):
    """The second derivative of a pair's part of the loss; the same from both sides."""
    e = np.exp(-np.abs(d))
    return t * e / ((1 + e) * (1 + e))


#: Products of a Newton step from which on it pays to make the forest anew, and how often its trees are joined with others.
FOREST_PAYS, FOREST_JOINS = 5, 2


def _joined(trees: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray):
    """Each tree joined with another by its heaviest of the edges (u, v, w), which all lead from one tree to another: the
    trees of the items then, and the places of the edges taken. An edge may be there twice. Edges that weigh the same go by
    their place, so no circle is made."""
    top, pick = np.zeros(len(trees)), np.full(len(trees), len(u), np.int32)
    for end in (u, v):
        np.maximum.at(top, trees[end], w)
    for end in (u, v):
        s = np.flatnonzero(w == top[trees[end]]).astype(np.int32)
        np.minimum.at(pick, trees[end[s]], s)
    tree = np.flatnonzero(pick < len(u))
    edge = pick[tree]
    to = np.arange(len(trees), dtype=np.int32)
    to[tree] = trees[u[edge]] + trees[v[edge]] - tree
    back = tree[(to[to[tree]] == tree) & (tree < to[tree])]
    to[back] = back
    while True:
        further = to[to]
        if (further == to).all():
            return to[trees], np.unique(edge)
        to = further


def _levels(u: np.ndarray, v: np.ndarray, t: np.ndarray, n: int) -> list:
    """The edges of a forest as [(item, next, t)], leaves first: an item of a level has no other edge but to later ones and to next."""
    at = np.arange(len(u), dtype=np.int32)
    degree, others, edges = np.zeros((3, n), np.int32)  # sums may wrap round, what is left of them at a leaf doesn't
    for x, y in ((u, v), (v, u)):
        np.add.at(degree, x, 1)
        np.add.at(others, x, y)
        np.add.at(edges, x, at)
    out, leaf = [], np.flatnonzero(degree == 1)
    while len(leaf):
        then = others[leaf]
        leaf = leaf[(degree[then] > 1) | (leaf < then)]  # of two that are left the smaller
        then = others[leaf]
        out.append((leaf.astype(np.int32), then.astype(np.int32), t[edges[leaf]]))
        degree[leaf] = 0
        for x, less in ((degree, 1), (others, leaf), (edges, edges[leaf])):
            np.subtract.at(x, then, less)
        then = np.unique(then)
        leaf = then[degree[then] == 1]
    return out


def _eased(diagonal: np.ndarray, theta: np.ndarray, levels: list) -> Callable[[np.ndarray], np.ndarray]:
    """The function that solves the second derivatives with all pairs outside the forest left out but on the diagonal."""
    left, steps = diagonal.copy(), []
    for item, then, t in levels:
        w = _weight(t, theta[item] - theta[then]) * (1 - 1e-9)
        part = w / left[item]
        np.subtract.at(left, then, w * part)
        steps.append((item, then, part))

    def solved(r):
        z = r.copy()
        for item, then, part in steps:
            np.add.at(z, then, part * z[item])
        z /= left
        for item, then, part in reversed(steps):
            z[item] += part * z[then]
        return z

    return solved


def solve_spread(edges: DataFrame, n: int, penalty: float = 1e-4, rounds: int = 200) -> np.ndarray:
    """The same strengths with the pairs left in Spark: Newton steps, each solved as far as it pays by conjugate gradients.
    The driver has some ten vectors of the items; a job goes over all pairs once.

    Where a few comparisons tie items to each other much more than to the rest (long chains, groups that win against all
    others), the diagonal alone eases too little. A forest of the pairs that weigh most is solved exactly as well, item by
    item from its leaves: each item's heaviest pair, then each tree's to another one. It has less than a pair an item, and
    is found by FOREST_JOINS jobs when a Newton step has taken more than FOREST_PAYS products.

    The optimum is the only one, and the gradient must vanish at what is returned (GRADIENT); else RuntimeError.

    edges: (ia, ib, wins_a, wins_b), kept packed in memory or on disk while it runs (see _packed). Tasks get the vectors,
    the strengths once a Newton step and one vector more for each product, and send back sums of their blocks of items.
    What goes to and fro for a product has single precision, as it only decides where to look; sums are made in double.
    """
    spark = edges.sparkSession
    prepare(spark)
    packs = _packed(edges, n).persist()
    unwon = packs.drop("w")

    def summed(at, along=None):
        """(loss, gradient, diagonal) of the pairs at shared strengths, or (0, their second derivative along a vector)."""
        kind = float if along is None else np.float32
        shared = None if along is None else spark.sparkContext.broadcast(along)

        def run(batches):
            t, x, sums, loss = at.value, None if shared is None else shared.value, {}, 0.0
            for batch in batches:
                for k in range(batch.num_rows):
                    first, size, i, j, won, all_ = _unpacked(batch, k)
                    out = sums.setdefault(first, np.zeros((2 if x is None else 1, size)))
                    d = t[first : first + size][i] - t[j]
                    if x is None:
                        loss += float(np.sum(won * np.logaddexp(0, -d)))
                        p = 1 / (1 + np.exp(-np.clip(d, -700, 700)))
                        out += [np.bincount(i, all_ * p - won, size), np.bincount(i, _weight(all_, d), size)]
                    else:
                        out += np.bincount(i, _weight(all_, d) * (x[first : first + size].astype(float)[i] - x[j]), size)
            for first, out in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([out.astype(kind).tobytes()], pa.binary()), pa.array([loss])], names=["first", "sums", "loss"])
                loss = 0.0

        parts = (packs if along is None else unwon).mapInArrow(run, "first long, sums binary, loss double").toArrow()
        if shared is not None:
            shared.destroy()
        total = np.zeros((2 if along is None else 1, n))
        for first, sums in zip(parts.column("first").to_pylist(), parts.column("sums"), strict=True):
            x = np.frombuffer(sums.as_buffer(), kind).reshape(len(total), -1)
            total[:, first : first + x.shape[1]] += x
        return sum(parts.column("loss").to_pylist()), *total

    def heaviest(at, trees):
        """(u, v, t) of the pairs that weigh most for an item of those that lead out of its tree and weigh more than the penalty."""
        shared = spark.sparkContext.broadcast(trees)

        def run(batches):
            theta, tree, most = at.value, shared.value, {}
            for batch in batches:
                for k in range(batch.num_rows):
                    first, size, i, j, _, t = _unpacked(batch, k)
                    top, to, of = most.setdefault(first, (np.full(size, penalty), np.full(size, -1, np.int32), np.zeros(size, np.float32)))
                    out = np.flatnonzero(tree[first : first + size][i] != tree[j])
                    i, j, t = i[out], j[out], t[out]
                    w = _weight(t, theta[first : first + size][i] - theta[j])
                    before = top.copy()
                    np.maximum.at(top, i, w)
                    new = np.flatnonzero((w == top[i]) & (w > before[i]))
                    to[i[new]], of[i[new]] = j[new], t[new]
            for first, (_, to, of) in most.items():
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([to.tobytes()], pa.binary()), pa.array([of.tobytes()], pa.binary())], names=["first", "to", "t"])

        parts = unwon.mapInArrow(run, "first long, to binary, t binary").toArrow()
        shared.destroy()
        u, v, t = [], [], []
        for first, to, of in zip(parts.column("first").to_pylist(), parts.column("to"), parts.column("t"), strict=True):
            to = np.frombuffer(to.as_buffer(), np.int32)
            some = np.flatnonzero(to >= 0).astype(np.int32)
            u.append(some + np.int32(first))
            v.append(to[some])
            t.append(np.frombuffer(of.as_buffer(), np.float32)[some])
        return np.concatenate(u), np.concatenate(v), np.concatenate(t)

    def forest(at, theta):
        trees, taken = np.arange(n, dtype=np.int32), []
        for _ in range(FOREST_JOINS):
            u, v, t = heaviest(at, trees)
            trees, e = _joined(trees, u, v, _weight(t, theta[u] - theta[v]))
            taken.append((u[e], v[e], t[e]))
        return _levels(*(np.concatenate(x) for x in zip(*taken, strict=True)), n)

    dot = lambda x, y: float(np.einsum("i,i->", x, y))  # noqa: E731  as in solve

    def evaluate(theta):
        at = spark.sparkContext.broadcast(theta)
        loss, g, diagonal = summed(at)
        return at, loss + 0.5 * penalty * dot(theta, theta), g + penalty * theta, diagonal + penalty

    theta, levels, products = np.zeros(n), [], 0
    at, loss, g, diagonal = evaluate(theta)
    for _ in range(rounds):
        if np.abs(g).max(initial=0) < GRADIENT / 10:
            break
        if products > FOREST_PAYS:
            levels = []  # not two forests at once
            levels = forest(at, theta)
        eased = _eased(diagonal, theta, levels)
        x, r, products = np.zeros(n), -g, 0
        d = eased(r)
        rz = least = dot(r, d)
        enough = min(0.1, 0.1 * rz**0.25)
        for _ in range(min(n, 500)):
            short = d.astype(np.float32)  # what is sent, so that it is the direction itself that is rounded
            d = short.astype(float)
            h = summed(at, short)[1] + penalty * d
            products += 1
            step = dot(r, d) / dot(d, h)
            x += step * d
            r -= step * h
            z = eased(r)
            new = dot(r, z)
            if new < enough * enough * least or np.abs(r).max() < GRADIENT / 20:
                break
            d = z + new / rz * d
            rz = new
        del eased, z, d, h
        size, slope = 1.0, dot(g, x)
        while True:
            at.destroy()
            at, new_loss, new_g, diagonal = evaluate(theta + size * x)
            if new_loss <= loss + 1e-4 * size * slope + 1e-12 * abs(loss) or size < 1e-6:
                break
            size /= 2
        theta, loss, g = theta + size * x, new_loss, new_g
        del x, r, short, new_g
    at.destroy()
    packs.unpersist()
    _settled(g)
    return theta - theta.mean()


def bradley_terry(comparisons: DataFrame, items: DataFrame, penalty: float = 1e-4) -> DataFrame:
    """(item, theta) for all items. comparisons: (a, b, outcome of A, B or tie); other outcomes are left out.

    Comparisons are collapsed to pairs in Spark, and items get numbers there. Up to DRIVER_PAIRS pairs are solved on the
    driver, as numbers; more stay in Spark. The vector of strengths is on the driver either way, 8 bytes an item, and goes
    back by number; the items themselves never leave Spark.
    """
    spark: SparkSession = comparisons.sparkSession
    one = items.select("item").filter("item is not null").distinct().withColumn("_cell", F.pmod(F.xxhash64("item"), F.lit(256))).withColumn("_one", F.lit(1))
    number = kept(running(one, "_one", ["item"], "i").select("item", F.col("i").cast("long").alias("i")))
    n = number.count()
    if not n:
        return number.select("item", F.lit(0.0).alias("theta"))
    end = lambda side: number.select(F.col("i").alias(f"i{side}"), F.col("item").alias(side))
    c = kept(collapsed(comparisons).join(end("a"), "a").join(end("b"), "b").select("ia", "ib", "wins_a", "wins_b"))
    if c.count() > DRIVER_PAIRS:
        theta = solve_spread(c, n, penalty)
    else:
        c = c.toPandas()
        theta = solve(c.ia.to_numpy(np.int64), c.ib.to_numpy(np.int64), c.wins_a.to_numpy(float), c.wins_b.to_numpy(float), n, penalty)
    prepare(spark)
    shared = spark.sparkContext.broadcast(theta)

    def strengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(shared.value[batch.column("i").to_numpy()])], names=["item", "theta"])

    return number.mapInArrow(strengths, f"item {number.schema['item'].dataType.simpleString()}, theta double")


def expected_wins(comparisons: DataFrame, strengths: DataFrame, penalty: float = 1e-4) -> DataFrame:
    """(item, wins, expected) for all items of strengths (item, theta): the wins there are, and those that the strengths
    lead one to expect. Where the penalised likelihood is largest, the two are the same for each item."""
    c = collapsed(comparisons)
    both = c.select(F.col("a").alias("item"), F.col("b").alias("other"), F.col("wins_a").alias("w"), "wins_a", "wins_b")
    both = both.unionByName(c.select(F.col("b").alias("item"), F.col("a").alias("other"), F.col("wins_b").alias("w"), "wins_a", "wins_b"))
    both = both.join(strengths.select("item", "theta"), "item").join(strengths.select(F.col("item").alias("other"), F.col("theta").alias("theirs")), "other")
    e = (F.col("wins_a") + F.col("wins_b")) / (1 + F.exp(F.col("theirs") - F.col("theta")))
    sums = both.groupBy("item").agg(F.sum("w").alias("wins"), F.sum(e).alias("expected"))
    nothing = lambda c: F.coalesce(c, F.lit(0.0))
    return strengths.join(sums, "item", "left").select("item", nothing(F.col("wins")).alias("wins"), (nothing(F.col("expected")) + penalty * F.col("theta")).alias("expected"))


def floor_normalised(df: DataFrame, column: str, cutoff: float | None, alias: str = "score") -> DataFrame:
    """df with column scaled to [0, 1]; at most the cutoff is 0 and the rest is scaled anew; a flat column is 0.5."""
    x = F.col("_x")
    floored = x if cutoff is None else F.when(x <= cutoff, 0.0).otherwise((x - cutoff) / (1 - cutoff))
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    out = df.crossJoin(ends).withColumn("_x", F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo")))
    return out.withColumn(alias, F.when(F.col("_hi") - F.col("_lo") < 1e-10, 0.5).otherwise(floored)).drop("_lo", "_hi", "_x")


def in_rounds(items: DataFrame, judge: Callable[[DataFrame], DataFrame], each: tuple[int, ...], seed: int = 0, cutoff: float | None = 0.1) -> DataFrame:
    """(item, theta, score) after len(each) rounds of about each[r] comparisons an item.

    The first round has random pairs, the others those of nearly the same strength. judge: from pairs with shown_a and
    shown_b to the same with `outcome` of what was shown (null where it failed); it is asked once for each round, as its
    answers are written before they are used. Every fit is on the comparisons of all rounds so far.
    """
    theta, asked = None, None
    for r, n in enumerate(each):
        pairs = shuffled_pairs(items, n, seed + r) if theta is None else adaptive_pairs(theta, n, seed + r)
        said = kept(unswapped(judge(swapped(pairs, seed + r))).select("a", "b", "outcome"))
        asked = said if asked is None else asked.unionByName(said)
        theta = bradley_terry(asked, items)
    return floor_normalised(theta, "theta", cutoff)


def by_occupation(scores: DataFrame, tasks: DataFrame, codes: DataFrame) -> DataFrame:
    """(onet_code, task_exposure_bt_mean, task_exposure_bt_importance_weighted) for all codes; without weights the mean.

    scores: (item, score); tasks: (item, onet_code, importance); codes: (onet_code).
    """
    mean = F.avg("score")
    weighted = F.try_divide(F.sum(F.col("score") * F.col("importance")), F.sum("importance"))
    out = scores.hint("merge").join(tasks, "item").groupBy("onet_code").agg(mean.alias("task_exposure_bt_mean"), F.coalesce(weighted, mean).alias("task_exposure_bt_importance_weighted"))
    return codes.join(out, "onet_code", "left")


__all__ = ["adaptive_pairs", "band_pairs", "band_partners", "bradley_terry", "by_occupation", "collapsed", "expected_wins", "floor_normalised", "in_rounds", "matched", "minmax", "shuffled_pairs", "solve", "swapped", "unswapped"]
