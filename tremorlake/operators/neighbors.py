"""Exact nearest neighbours as a distributed join.

Points are cut into boxes in rounds. Each round splits every box that holds too many points along its
widest axis: what lies at the low end apart from the rest, and the rest by quantiles. If most points
lie at the low end, as in sparse vectors, they go by the first axis on which they don't. So a
round always gets on, whatever share of the values are equal. Boxes and their bounds are tables, and
points find their part by a join with the boxes that are split. The boxes of all rounds are a tree.

Each box finds the neighbours inside itself, which bounds how far any better neighbour can be. A
point of a box with too few others takes its bound from the smallest box above that has enough. Then
every point goes down the tree by a join per round, into the boxes that are near enough,
and asks those it comes to. Both searches are shuffles by box, and no box or request list outgrows one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.session import cut_lineage

# What runs in tasks travels with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Points per box at most, and requests per task.
BOX_POINTS = 4096
BOX_REQUESTS = 4096
# A box is named by its parts, a character for each round, so the box above has one character less.
NAMES = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_"
PARTS = len(NAMES)
# Distances held at once in a task.
BLOCK = 2_000_000


def _axes(dims: int) -> list[Column]:
    return [F.get("v", F.lit(i)) for i in range(dims)]


def _above(box: str, depth: int) -> Column:
    """The box that this one is in after so many rounds."""
    return F.left(F.col(box), F.lit(depth))


def _bounds(placed: DataFrame, dims: int, box: Column) -> DataFrame:
    """``box, n, low, high``: the points of each box, counted, and their extremes."""
    return placed.groupBy(box.alias("box")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.min(x) for x in _axes(dims)]).alias("low"),
        F.array(*[F.max(x) for x in _axes(dims)]).alias("high"),
    )


def _splits(placed: DataFrame, bounds: DataFrame, dims: int, box_points: int) -> DataFrame:
    """``box, axis, cuts, low, axes``: for every box that holds too many points how it is split.

    ``cuts`` are places on the widest axis that has at least half of the points above its low end. If no axis
    has, there are none, and a point goes by the first of ``axes`` on which it is above. So each part
    has half of the points at most, but for what quantiles are off.
    """
    full = bounds.filter(F.col("n") > box_points).select("box", "n", "low", "high")
    measures = []
    for i, x in enumerate(_axes(dims)):
        above = F.when(x > F.get("low", F.lit(i)), x)
        spots = F.percentile_approx(above, [k / PARTS for k in range(1, PARTS)], 10 * PARTS)
        measures.append(
            F.struct(
                (2 * F.count(above) >= F.max("n")).alias("even"),
                (F.max(F.get("high", F.lit(i))) - F.max(F.get("low", F.lit(i)))).alias("width"),
                F.lit(-i).alias("axis"),
                F.min(above).alias("first"),
                spots.alias("spots"),
            )
        )
    measured = placed.join(full, "box").groupBy("box").agg(
        F.max("n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"), F.array_max(F.array(*measures)).alias("best")
    )
    wanted = F.least(F.lit(PARTS - 1), F.ceil(2 * F.col("n") / box_points))
    some = F.filter("best.spots", lambda _, k: F.floor((k + 1) * wanted / PARTS) > F.floor(k * wanted / PARTS))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("best.first"), some)))
    wide = F.filter(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.get("high", i) > F.get("low", i))
    return measured.select(
        "box",
        (-F.col("best.axis")).alias("axis"),
        F.when(F.col("best.even"), F.slice(cuts, 1, PARTS - 1)).alias("cuts"),
        "low",
        F.slice(wide, 1, PARTS - 1).alias("axes"),
    )


def boxed(points: DataFrame, dims: int, box_points: int) -> tuple[DataFrame, DataFrame, int]:
    """``id, v, box`` with no box over its limit, the boxes' bounds, and the number of rounds it took.

    ``points`` is stored and no two points share a vector, so a box with two points can always be split.
    """
    placed, rounds = points.withColumn("box", F.lit("")), 0
    while True:
        bounds = cut_lineage(_bounds(placed, dims, F.col("box")), "boxes")
        if bounds.filter(F.col("n") > box_points).isEmpty():
            return placed, bounds, rounds
        splits = cut_lineage(_splits(placed, bounds, dims, box_points), "splits")
        by_cuts = F.size(F.filter("cuts", lambda cut: cut <= F.expr("get(v, axis)")))
        off = F.transform("axes", lambda i: F.get("v", i) > F.get("low", i))
        by_axes = F.array_position(off, True).cast("int")
        known = placed.join(splits, "box", "left")
        number = F.when(F.col("axes").isNull(), 0).when(F.col("cuts").isNull(), by_axes).otherwise(by_cuts)
        moved = F.concat("box", F.substr(F.lit(NAMES), number + 1, F.lit(1)))
        placed, rounds = cut_lineage(known.select("id", "v", moved.alias("box")), "placed"), rounds + 1


def _gap(dims: int) -> Column:
    """Squared distance of a point from a box's bounds, 0 inside."""
    total = F.lit(0.0)
    for i, x in enumerate(_axes(dims)):
        short = F.greatest(F.get("low", F.lit(i)) - x, x - F.get("high", F.lit(i)), F.lit(0.0))
        total = total + short * short
    return total


def _farthest(dims: int) -> Column:
    """Squared distance of a point from the far corner of a box's bounds."""
    total = F.lit(0.0)
    for i, x in enumerate(_axes(dims)):
        far = F.greatest(F.abs(F.get("low", F.lit(i)) - x), F.abs(x - F.get("high", F.lit(i))))
        total = total + far * far
    return total


def _nearest(
    queries: pd.DataFrame, points: pd.DataFrame, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (query rows, neighbour ids, squared distances); ties go to the lower id."""
    points = points.sort_values("id", kind="stable")
    ids = points["id"].to_numpy()
    at = np.stack(points["v"].to_numpy())
    asked = np.stack(queries["v"].to_numpy())
    own = queries["id"].to_numpy()
    step = max(1, BLOCK // len(ids))
    for start in range(0, len(asked), step):
        rows = slice(start, start + step)
        squared = np.zeros((len(asked[rows]), len(ids)))
        for axis in range(at.shape[1]):
            gap = asked[rows, axis][:, None] - at[:, axis][None, :]
            squared += gap * gap
        squared[own[rows][:, None] == ids[None, :]] = np.inf
        order = np.argsort(squared, axis=1, kind="stable")[:, :k]
        yield own[rows], ids[order], np.take_along_axis(squared, order, axis=1)


def _long(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    parts = []
    for own, ids, squared in found:
        width = ids.shape[1]
        parts.append(
            pd.DataFrame({"id": np.repeat(own, width), "neighbor": ids.ravel(), "squared": squared.ravel()})
        )
    table = pd.concat(parts)
    return table[np.isfinite(table["squared"])]


def _levels(bounds: DataFrame, dims: int, rounds: int) -> list[DataFrame]:
    """The bounds of every box of every round, the root first."""
    levels = [bounds]
    for depth in reversed(range(rounds)):
        above = levels[0].groupBy(_above("box", depth).alias("box")).agg(
            F.sum("n").alias("n"),
            F.array(*[F.min(F.get("low", F.lit(i))) for i in range(dims)]).alias("low"),
            F.array(*[F.max(F.get("high", F.lit(i))) for i in range(dims)]).alias("high"),
        )
        levels.insert(0, cut_lineage(above, "upper-boxes"))
    return levels


def _reach(placed: DataFrame, home: DataFrame, levels: list[DataFrame], k: int, dims: int) -> DataFrame:
    """``id, v, home, reach``: every point with a squared distance that its ``k`` nearest don't pass."""
    rounds = len(levels) - 1
    few = levels[-1].filter(F.col("n") <= k)
    found = None
    for up in range(1, rounds + 1):
        # The lowest box above that holds enough; points of small boxes only.
        named = few.select("box", _above("box", rounds - up).alias("above"))
        enough = levels[rounds - up].filter(F.col("n") > k).select(F.col("box").alias("above"), "low", "high")
        here = named.join(enough, "above").select("box", "low", "high", F.lit(up).alias("up"))
        found = here if found is None else found.unionByName(here)
    nearest = found.groupBy("box").agg(F.min_by(F.struct("low", "high"), "up").alias("around"))
    nearest = cut_lineage(nearest.select("box", "around.low", "around.high"), "roomy-boxes")
    bound = home.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("squared")).alias("known"))
    asking = placed.join(bound, "id", "left").join(nearest, "box", "left")
    reach = F.coalesce("known", F.when(F.col("low").isNotNull(), _farthest(dims)), F.lit(float("inf")))
    return asking.select("id", "v", F.col("box").alias("home"), reach.alias("reach"))


def _requests(asking: DataFrame, levels: list[DataFrame], dims: int) -> DataFrame:
    """``id, v, leaf``: the boxes other than its own that a point must ask, found by going down the tree."""
    rounds = len(levels) - 1
    rows = asking.withColumn("at", F.lit(""))
    for depth in range(1, rounds + 1):
        parts = levels[depth].select(_above("box", depth - 1).alias("at"), "box", "low", "high")
        own = F.col("home") == F.col("box")
        near = _gap(dims) <= F.col("reach") * (1 + 1e-9)
        # On the last level a point's own box has answered already.
        wanted = near & ~own if depth == rounds else near
        rows = rows.join(parts, "at").filter(wanted).select("id", "v", "home", "reach", F.col("box").alias("at"))
        rows = cut_lineage(rows, "requests")
    return rows.select("id", "v", F.col("at").alias("leaf"))


def nearest_neighbors(points: DataFrame, k: int, box_points: int = BOX_POINTS) -> DataFrame:
    """The ``k`` nearest other points of each point: ``id, neighbor, squared, rank``.

    ``points`` has a unique ``id`` and a vector ``v`` (array of double, all of one length) that no
    two points share: fold copies first, so that no box is full of one place.
    """
    id_type = points.schema["id"].dataType
    stored = cut_lineage(points.select("id", "v"), "points")
    dims = stored.agg(F.max(F.size("v"))).first()[0] or 0
    found_schema = T.StructType(
        [T.StructField("id", id_type), T.StructField("neighbor", id_type), T.StructField("squared", T.DoubleType())]
    )
    placed, bounds, rounds = boxed(stored, dims, box_points)

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        return _long(_nearest(group, group, k))

    home = placed.groupBy("box").applyInPandas(inside, found_schema)
    if not rounds:
        return _ranked(home, k)
    home = cut_lineage(home, "home-neighbors")
    levels = _levels(bounds, dims, rounds)
    requests = _requests(_reach(placed, home, levels, k, dims), levels, dims)
    # A box many points ask is copied as often as its requests fill tasks.
    shares = requests.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BOX_REQUESTS).alias("shares"))
    shares = cut_lineage(shares, "shares")
    spread = requests.join(shares, "leaf").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")))
    copies = placed.withColumnRenamed("box", "leaf").join(shares, "leaf").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))
    )

    def elsewhere(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"id": [], "neighbor": [], "squared": []})
        return _long(_nearest(asked, held, k))

    away = (
        spread.select("id", "v", "leaf", "share")
        .groupBy("leaf", "share")
        .cogroup(copies.select("id", "v", "leaf", "share").groupBy("leaf", "share"))
        .applyInPandas(elsewhere, found_schema)
    )
    return _ranked(home.unionByName(away), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("id").orderBy("squared", "neighbor")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
