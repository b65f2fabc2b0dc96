"""Class balancing: synthetic minority rows, then removal of Tomek links.

Both steps look at distinct vectors, so rows that are copies of one another
never meet pairwise. Choices that would be random come from a hash of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.operators.neighbors import BOX_POINTS, nearest_neighbors
from tremorlake.operators.ranking import rank_in_levels
from tremorlake.operators.split import row_digest
from tremorlake.schema import FEATURES, SEED, TARGET
from tremorlake.session import cut_lineage

# Fixed value: neighbours a synthetic row may lean towards.
NEIGHBORS = 5
# Synthetic rows made from one row by one task.
CHUNK = 1000


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") + F.lit(0.0) for f in features])


def keyed(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One text id per row."""
    return features.withColumn("id", F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def tomek_links(
    rows: DataFrame, features: Sequence[str] = FEATURES, label: str = TARGET, box_points: int = BOX_POINTS
) -> DataFrame:
    """Ids of rows in a link: mutual nearest neighbours of opposite classes.

    Ties in distance go to the lower id. Among copies of one vector the two
    lowest ids are each other's nearest, and nothing else can be mutual there.
    """
    placed = cut_lineage(rows.select("id", F.col(label).cast("int").alias("y"), _vector(features).alias("v")), "tomek")
    by_id = Window.partitionBy("v").orderBy("id")
    lowest = placed.withColumn("place", F.row_number().over(by_id)).filter("place <= 2")
    folded = cut_lineage(
        lowest.groupBy("v").agg(
            F.min(F.struct("id", "y")).alias("first"), F.max(F.struct("id", "y")).alias("second")
        ),
        "vectors",
    )
    copied = F.col("first.id") != F.col("second.id")
    twins = folded.filter(copied & (F.col("first.y") != F.col("second.y"))).select(
        F.explode(F.array("first.id", "second.id")).alias("id")
    )
    single = folded.select(F.col("first.id").alias("id"), F.col("first.y").alias("y"), (~copied).alias("single"))
    points = folded.select(F.col("first.id").alias("id"), "v")
    nearest = cut_lineage(nearest_neighbors(points, 1, box_points).select("id", "neighbor"), "nearest")
    judged = nearest.join(single, "id").filter("single").select("id", "neighbor", "y")
    back = judged.select(
        F.col("id").alias("neighbor"), F.col("neighbor").alias("id"), F.col("y").alias("other")
    )
    linked = judged.join(back, ["id", "neighbor"]).filter("y != other").select("id")
    return linked.unionByName(twins)


def smote_oversample(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = TARGET,
    k: int = NEIGHBORS,
    seed: int = SEED,
    box_points: int = BOX_POINTS,
    one_class: bool = False,
) -> DataFrame:
    """Add synthetic rows until both classes are equal: ``id, v, y, synthetic``.

    Every minority row gives the same number of synthetic rows (give or take
    one); each lies between the row and one of its ``k`` nearest minority rows.
    With ``one_class`` rows of fewer than two classes stay as they are, else they are an error.
    """
    spark = rows.sparkSession
    placed = cut_lineage(rows.select("id", F.col(label).cast("int").alias("y"), _vector(features).alias("v")), "smote")
    sizes = {r["y"]: r["n"] for r in placed.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = placed.withColumn("synthetic", F.lit(False))
    if one_class and len(sizes) < 2:
        return base
    if len(sizes) != 2:
        raise ValueError(f"resampling needs two classes, found {sorted(sizes)}")
    minority = min(sizes, key=lambda y: (sizes[y], y))
    few, many = min(sizes.values()), max(sizes.values())
    if few < 2 or few == many:
        return base

    small = placed.filter(F.col("y") == minority)
    vectors = cut_lineage(
        small.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "minority"
    )
    near = nearest_neighbors(vectors.select("id", "v"), k, box_points)
    # The k nearest distinct vectors, each counted as often as it is held: at most k entries.
    others = vectors.select(F.col("id").alias("neighbor"), F.col("v").alias("w"), F.col("copies").alias("held"))
    lists = (
        near.join(others, "neighbor")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "held", "w"))).alias("others"))
    )
    known = vectors.join(lists, "id", "left").select("v", "copies", "others")

    each, extra = divmod(many - few, few)
    digest = row_digest("id", salt=str(seed))
    levels = {"_coarse": F.substring(digest, 1, 2), "_fine": F.substring(digest, 3, 2)}
    ranked = rank_in_levels(small, levels, [digest], name="place")
    wanted = ranked.withColumn("n", F.lit(each) + (F.col("place") <= extra).cast("int")).filter("n > 0")
    chunks = wanted.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK))))
    seeds = (
        chunks.join(known, "v")
        .repartition("id", "chunk")
        .withColumn(
            "copy",
            F.explode(
                F.sequence(F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1)
            ),
        )
    )

    def draw(purpose: int) -> Column:
        """A 48-bit number from the digest of the row, its copy number and the purpose."""
        digits = F.substring(row_digest("id", "copy", salt=f"{seed}:{purpose}"), 1, 12)
        return F.conv(digits, 16, 10).cast("long")

    # Neighbour number among the k nearest rows: copies of the row itself come first.
    own = F.least(F.col("copies") - 1, F.lit(k))
    reachable = own + F.aggregate(
        F.coalesce("others", F.array().cast("array<struct<rank:int,held:bigint,w:array<double>>>")),
        F.lit(0).cast("long"),
        lambda total, o: total + o["held"],
    )
    pick = draw(1) % F.least(F.lit(k).cast("long"), reachable)
    walked = F.aggregate(
        "others",
        F.struct(
            F.col("pick").alias("left"), F.lit(None).cast("array<double>").alias("w")
        ),
        lambda state, o: F.when(
            state["w"].isNull() & (state["left"] < o["held"]), F.struct(state["left"].alias("left"), o["w"].alias("w"))
        ).otherwise(F.struct((state["left"] - o["held"]).alias("left"), state["w"].alias("w"))),
    )["w"]
    share = draw(2) / F.lit(float(1 << 48))
    toward = F.when(F.col("pick") < 0, F.col("v")).otherwise(walked)
    made = (
        seeds.withColumns({"pick": pick - own, "share": share})
        .withColumn("w", toward)
        .select(
            F.concat_ws("#", "id", F.col("copy").cast("string")).alias("id"),
            F.lit(minority).alias("y"),
            F.zip_with("v", "w", lambda a, b: a + F.col("share") * (b - a)).alias("v"),
            F.lit(True).alias("synthetic"),
        )
    )
    return base.unionByName(made)


def resample(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = TARGET,
    seed: int = SEED,
    box_points: int = BOX_POINTS,
    one_class: bool = False,
) -> DataFrame:
    """Oversample, drop both ends of every link, and give the columns their types back.

    With ``one_class`` rows of fewer than two classes, which have no links either, stay as they are.
    """
    types = dict(rows.dtypes)
    made = smote_oversample(rows, features, label, seed=seed, box_points=box_points, one_class=one_class)
    balanced = cut_lineage(made, "balanced")
    columns = [F.get("v", F.lit(i)).alias(f) for i, f in enumerate(features)]
    wide = balanced.select("id", F.col("y").alias(label), "synthetic", *columns)
    links = tomek_links(wide, features, label, box_points)
    kept = wide.join(links, "id", "left_anti")
    return kept.withColumns({f: F.col(f).cast(types[f]) for f in features})
