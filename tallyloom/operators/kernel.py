"""Kernel density on a grid, density classification, kernel nearest neighbours in one dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import normal_density, ratio
from tallyloom.operators.ordered import running, running_by
from tallyloom.session import stage


def priors(df: DataFrame, cls: str) -> DataFrame:
    """Share of each class."""
    counts = df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
    # one row per class
    return counts.withColumn("prior", F.col("n") / F.sum("n").over(Window.partitionBy()))


def bounds(df: DataFrame, x1: str, x2: str) -> Column:
    """Smallest and largest value of both axes as one struct."""
    return df.agg(F.struct(
        F.min(x1).alias("a1"), F.max(x1).alias("b1"), F.min(x2).alias("a2"), F.max(x2).alias("b2"))).scalar()


#: Rows whose kernel values are worked out together, and classes summed up at a time.
DENSITY_ROWS, DENSITY_CLASSES = 2048, 64


def _node_sums(x: np.ndarray, y: np.ndarray, g1: np.ndarray, g2: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Sum over the rows of the kernel at every node.

    A diagonal bandwidth is a product of two one-dimensional kernels: m + m values a row and one
    matrix product. Otherwise the rows are turned first and each gives m x m values.
    """
    out = np.zeros((len(g1), len(g2)))
    separable = inverse[0, 1] == 0 and inverse[1, 0] == 0
    size = DENSITY_ROWS if separable else max(1, DENSITY_ROWS * 64 // out.size)
    for start in range(0, len(x), size):
        d1, d2 = g1 - x[start : start + size, None], g2 - y[start : start + size, None]
        if separable:
            out += np.exp(-0.5 * (d1 * inverse[0, 0]) ** 2).T @ np.exp(-0.5 * (d2 * inverse[1, 1]) ** 2)
        else:
            u1 = d1[:, :, None] * inverse[0, 0] + d2[:, None, :] * inverse[1, 0]
            u2 = d1[:, :, None] * inverse[0, 1] + d2[:, None, :] * inverse[1, 1]
            out += np.exp(-0.5 * (u1 * u1 + u2 * u2)).sum(axis=0)
    return out


def grid_density(df: DataFrame, x1: str, x2: str, bandwidth: np.ndarray, m: int, cls: str | None = None) -> DataFrame:
    """Product-kernel density on an m x m grid over the range of the data, per class if asked.

    Each task adds up the kernels of its rows on the fixed grid and passes on m x m sums a
    class; no row is multiplied by the nodes. Rows without both coordinates take no part, a null
    class is a class, and an empty table has no nodes.
    """
    inverse, det = np.linalg.inv(bandwidth), float(np.linalg.det(bandwidth))
    keys = [cls] if cls else []
    span = df.agg(F.min(x1).alias("a1"), F.max(x1).alias("b1"), F.min(x2).alias("a2"), F.max(x2).alias("b2"))
    limits = [F.col(f"_span.{c}").cast("double").alias(f"_{c}") for c in ("a1", "b1", "a2", "b2")]
    rows = df.filter(F.col(x1).isNotNull() & F.col(x2).isNotNull()).select(
        *keys, F.col(x1).cast("double").alias("_x"), F.col(x2).cast("double").alias("_y"), span.select(F.struct("*")).scalar().alias("_span")
    ).select(*keys, "_x", "_y", *limits)
    kind = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*keys).schema) + "i int, j int, _sum double, _n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[object, np.ndarray] = {}
        counts: dict[object, int] = {}
        i, j = (v.ravel().astype(np.int32) for v in np.meshgrid(np.arange(m), np.arange(m), indexing="ij"))

        def out() -> Iterator[pa.RecordBatch]:
            for c, total in sums.items():
                named = [pa.array([c] * m * m, class_type)] if cls else []
                yield pa.RecordBatch.from_arrays(
                    [*named, pa.array(i), pa.array(j), pa.array(total.ravel()), pa.array(np.full(m * m, counts[c]))],
                    names=[*keys, "i", "j", "_sum", "_n"])

        class_type = None
        for b in batches:
            if not b.num_rows:
                continue
            class_type = b.column(0).type
            x, y, a1, b1, a2, b2 = (b.column(len(keys) + k).to_numpy() for k in range(6))
            steps = np.arange(m) / max(m - 1, 1)
            g1, g2 = a1[0] + (b1[0] - a1[0]) * steps, a2[0] + (b2[0] - a2[0]) * steps
            classes, place = [None], np.zeros(b.num_rows, dtype=int)
            if cls:
                coded = b.column(0).dictionary_encode(null_encoding="encode")
                classes, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for k, c in enumerate(classes):
                mine = place == k
                found = _node_sums(x[mine], y[mine], g1, g2, inverse)
                sums[c] = sums[c] + found if c in sums else found
                counts[c] = counts.get(c, 0) + int(mine.sum())
            if len(sums) > DENSITY_CLASSES:
                yield from out()
                sums, counts = {}, {}
        yield from out()

    totals = rows.mapInArrow(run, kind).groupBy(*keys, "i", "j").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    s = F.col("_s")
    nodes = totals.withColumn("_s", span.select(F.struct("*")).scalar())
    return nodes.select(
        *keys, "i", "j", (s["a1"] + (s["b1"] - s["a1"]) * F.col("i") / max(m - 1, 1)).alias("g1"),
        (s["a2"] + (s["b2"] - s["a2"]) * F.col("j") / max(m - 1, 1)).alias("g2"),
        (F.col("_sum") / F.col("_n") / (2 * float(np.pi) * det)).alias("density"))


def classify_grid(df: DataFrame, x1: str, x2: str, cls: str, bandwidth: np.ndarray, m: int) -> DataFrame:
    """Posterior class shares at each node: prior x density, normalised."""
    density = grid_density(df, x1, x2, bandwidth, m, cls)
    weighted = density.join(priors(df, cls).select(cls, "prior"), cls).withColumn(
        "_h", F.col("density") * F.col("prior"))
    # m^2 nodes x classes
    total = F.sum("_h").over(Window.partitionBy("i", "j"))
    return weighted.select("i", "j", "g1", "g2", cls, ratio("_h", total).alias("posterior"))


def grid_classes(posterior: DataFrame, cls: str) -> DataFrame:
    """Most likely class of each node; the smallest label wins a tie."""
    best = F.min(F.struct((-F.col("posterior")).alias("p"), F.col(cls).alias("c")))
    return posterior.groupBy("i", "j").agg(best.alias("b")).select(
        "i", "j", F.col("b.c").alias("predicted"), (-F.col("b.p")).alias("posterior"))


def nearest_node(df: DataFrame, x1: str, x2: str, m: int) -> DataFrame:
    """Add the grid node (i, j) nearest to each row."""
    span = bounds(df, x1, x2)

    def node(x: str, lo: Column, hi: Column) -> Column:
        place = ratio((F.col(x) - lo) * (m - 1), hi - lo)
        return F.coalesce(F.floor(place + 0.5), F.lit(0)).cast("int")

    return df.withColumn("_s", span).withColumns({
        "i": node(x1, F.col("_s.a1"), F.col("_s.b1")), "j": node(x2, F.col("_s.a2"), F.col("_s.b2"))}).drop("_s")


def classify_rows(df: DataFrame, x1: str, x2: str, cls: str, bandwidth: np.ndarray, m: int) -> DataFrame:
    """Class of each row, read off the node nearest to it."""
    classes = grid_classes(classify_grid(df, x1, x2, cls, bandwidth, m), cls)
    return nearest_node(df, x1, x2, m).join(classes.select("i", "j", "predicted"), ["i", "j"])


# Nearest neighbours on a line: the k nearest of a point are among the k distinct values on
# either side of it, so sorted blocks with k values of overlap are enough. Rows with equal x
# fold into one (count, sum, sum of squares) first, whatever their number. A block with very many
# queries between its points is cut into parts, each with all points of the block.


def _blocks(points: DataFrame, queries: DataFrame | None, k: int, size: int, group: list[str] | None = None) -> DataFrame:
    """Rows of the sorted blocks; lines of different ``group`` values are lines of their own."""
    group = group or []
    folded = points.groupBy(*group, "x").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.lit(queries is None).alias("wanted"))
    if queries is not None:
        asked = queries.select(*group, F.col("x"), F.lit(0.0).alias("n"), F.lit(0.0).alias("sy"), F.lit(0.0).alias("syy"),
                               F.lit(True).alias("wanted"))
        folded = folded.unionByName(asked).groupBy(*group, "x").agg(
            F.sum("n").alias("n"), F.sum("sy").alias("sy"), F.sum("syy").alias("syy"), F.max("wanted").alias("wanted"))
    sums = {"position": (F.col("n") > 0).cast("long"), "asked": (F.col("n") == 0).cast("long")}
    placed = running_by(folded, group, "x", [], sums, position=None) if group else running(folded, "x", [], sums, position=None)
    placed = placed.withColumn("part", F.floor(F.col("asked") / size)).drop("asked")
    block = F.explode(F.sequence(
        F.floor((F.col("position") - k - 1) / size), F.floor((F.col("position") + k + 1) / size)))
    home = F.floor(F.col("position") / size)
    copies = placed.withColumn("_home", home).withColumn("block", block)
    copies = copies.withColumn("home", F.col("block") == F.col("_home")).drop("_home")
    copies = stage(copies.filter((F.col("n") > 0) | F.col("home")), "blocks")
    parts = stage(copies.filter("home").groupBy(*group, "block").agg(F.min("part").alias("_from"), F.max("part").alias("_to")), "parts")
    spread = copies.withColumnRenamed("part", "_own").join(parts, [*group, "block"]).withColumn(
        "part", F.explode(F.when(F.col("n") > 0, F.sequence("_from", "_to")).otherwise(F.array("_own"))))
    return spread.withColumn("home", F.col("home") & (F.col("part") == F.col("_own"))).drop("_own", "_from", "_to")


def _near(block: pd.DataFrame, k: int):
    """Queries of the block, and for each the 2k + 2 values around it."""
    rows = block.sort_values("x")
    data = rows[rows["n"] > 0]
    x, n = data["x"].to_numpy(), data["n"].to_numpy()
    sy = data["sy"].to_numpy()
    asked = rows[rows["wanted"] & rows["home"]]
    q = asked["x"].to_numpy()
    at = np.searchsorted(x, q)
    columns = at[:, None] + np.arange(-k - 1, k + 2)[None, :]
    valid = (columns >= 0) & (columns < len(x))
    columns = np.clip(columns, 0, max(len(x) - 1, 0))
    distance = np.where(valid, np.abs(x[columns] - q[:, None]), np.inf)
    return asked, distance, np.where(valid, n[columns], 0.0), np.where(valid, sy[columns], 0.0)


def _closer(distance: np.ndarray, count: np.ndarray):
    """Order by distance and count the points strictly nearer than each."""
    order = np.argsort(distance, axis=1, kind="stable")
    d = np.take_along_axis(distance, order, 1)
    c = np.take_along_axis(count, order, 1)
    before = np.cumsum(c, axis=1) - c
    new = np.ones(d.shape, bool)
    new[:, 1:] = d[:, 1:] != d[:, :-1]
    return order, d, np.maximum.accumulate(np.where(new, before, 0.0), axis=1)


def _kernel(d: np.ndarray, h: float) -> np.ndarray:
    return np.exp(-0.5 * (d / h) ** 2) / (np.sqrt(2 * np.pi) * h)


def knn_regression(points: DataFrame, queries: DataFrame, h: float, k: int, block: int = 20000) -> DataFrame:
    """Kernel-weighted mean of y over the k nearest points of each query x, ties at k kept."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, distance, n, sy = _near(pdf, k)
        if not len(asked):
            return pd.DataFrame({"x": [], "fitted": []})
        order, d, closer = _closer(distance, n)
        weight = np.where((closer < k) & np.isfinite(d), _kernel(np.where(np.isfinite(d), d, 0.0), h), 0.0)
        top = (weight * np.take_along_axis(sy, order, 1)).sum(axis=1)
        bottom = (weight * np.take_along_axis(n, order, 1)).sum(axis=1)
        fitted = np.divide(top, bottom, out=np.full(len(top), np.nan), where=bottom > 0)
        return pd.DataFrame({"x": asked["x"].to_numpy(), "fitted": fitted})

    out = _blocks(points, queries, k, block).groupBy("block", "part").applyInPandas(fit, "x double, fitted double")
    return out.withColumn("fitted", F.nanvl("fitted", F.lit(None)))


def leave_one_out(
    points: DataFrame, bandwidths: list[float], neighbours: list[int], block: int = 20000, group: str | None = None,
) -> DataFrame:
    """Mean squared leave-one-out error for every (h, k); null where some point has no weight.

    The neighbour table is made once, up to the largest k. Only one line per (block, h, k)
    leaves a task. Rows of different ``group`` values (not null) are scored apart, in the same job.
    """
    k, keys = max(neighbours), [group] if group else []

    def score(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        asked, distance, n, sy = _near(pdf, k)
        own_n, own_y, own_yy = (asked[c].to_numpy() for c in ("n", "sy", "syy"))
        others = np.where(distance == 0, n - 1, n)
        order, d, closer = _closer(distance, others)
        finite = np.isfinite(d)
        counts, sums = np.take_along_axis(n, order, 1), np.take_along_axis(sy, order, 1)
        rows = []
        for h in bandwidths:
            kernel = np.where(finite, _kernel(np.where(finite, d, 0.0), h), 0.0)
            self_weight = float(_kernel(np.zeros(1), h)[0])
            for kk in neighbours:
                w = kernel * (closer < kk)
                a, b = (w * sums).sum(axis=1), (w * counts).sum(axis=1)
                rest = b - self_weight
                # sum over the rows of one x of (y - prediction without the row)^2
                error = b * b * own_yy - 2 * a * b * own_y + own_n * a * a
                good = rest > 1e-12 * b
                value = np.divide(error, rest * rest, out=np.zeros(len(rest)), where=good)
                rows.append((*key[: len(keys)], h, kk, float(value.sum()), float(own_n.sum()), int((~good).sum())))
        return pd.DataFrame(rows, columns=[*keys, "bandwidth", "neighbours", "error", "rows", "bad"])

    kind = "".join(f"{g} {points.schema[g].dataType.simpleString()}, " for g in keys)
    parts = _blocks(points, None, k, block, keys).groupBy(*keys, "block", "part").applyInPandas(
        score, kind + "bandwidth double, neighbours int, error double, rows double, bad int")
    return parts.groupBy(*keys, "bandwidth", "neighbours").agg(
        F.when(F.sum("bad") == 0, F.sum("error") / F.sum("rows")).alias("score"))


def best_score(scores: DataFrame, columns: list[str], score: str = "score") -> DataFrame:
    """Row with the lowest score, ties by the listed columns."""
    best = F.min(F.struct(score, *columns))
    return scores.filter(F.col(score).isNotNull()).agg(best.alias("b")).select("b.*")


def single_index(df: DataFrame, x1: str, x2: str, y: str, directions: list[float], h: float, k: int) -> DataFrame:
    """Leave-one-out error of y on x1 + b x2 for each direction b, all directions in one neighbour table."""
    direction = F.explode(F.array(*[F.lit(float(b)) for b in dict.fromkeys(directions)])).alias("direction")
    turned = df.select(F.col(x1).alias("_a"), F.col(x2).alias("_b"), F.col(y).alias("y"), direction).select(
        "direction", (F.col("_a") + F.col("direction") * F.col("_b")).alias("x"), "y")
    return leave_one_out(turned, [h], [k], group="direction").select("direction", "score")


def nearest_with_ties(df: DataFrame, query: str, distance: str, k: int) -> DataFrame:
    """Rows of each query with distance up to the k-th smallest, ties kept."""
    w = Window.partitionBy(query).orderBy(distance)
    return df.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") <= k).drop("_rank")

