"""Links within groups, and the components they make, as Spark jobs.

Candidates come as rows (key, node): nodes that share a key may be alike. Every node is
first compared with the smallest of its group, which settles groups of copies in as many
comparisons as they have members. What is left of a group are its other members, where they
still lie in several components; groups with the same members left count once. A few members are
compared pair by pair, each pair once for all groups. More are cut
into blocks of bounded size, and every two blocks of a group meet in one task. There each
member from outside the group's main component is held against all members at once, by
counting the elements it shares with each, exactly. A task returns a link only where it
joins two components, so the rows are bounded by the members, and no link that matters is
lost. Time is the group's size times its members outside the main component, in tasks of
bounded memory that run side by side.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.session import cut_lineage

# Rows of two whole numbers up to which a table is sent to every executor: 16 bytes each,
# about 60 in the hash table, so 30 MB. Larger tables are joined by Spark's own choice.
SENT_ROWS = 500_000
# Characters and members of a block, on average. Two of them meet in a task, as some ten
# arrays of eight bytes for each character at most: under 200 MB. A longer text is a block.
BLOCK_CHARS, BLOCK_NODES = 1_000_000, 2_000
# Members left up to which a group is cheaper as pairs, 28 at most, than as a task's block.
PAIR_NODES = 8


def join_narrow(rows: DataFrame, narrow: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a stored table of fixed-width rows, sent to the executors if it is counted to be small."""
    small = narrow.count() <= SENT_ROWS
    return rows.join(F.broadcast(narrow) if small else narrow, on, how)


def shared_keys(rows: DataFrame) -> DataFrame:
    """``key, node, first``: the members of every key with two nodes or more, each once."""
    groups = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    groups = cut_lineage(groups.filter("first < last").select("key", "first"), "shared-keys")
    return cut_lineage(join_narrow(rows.select("key", "node"), groups, "key").distinct(), "members")


def star_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: the first node of a key with each other node of it."""
    return members.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()


def met_contents(members: DataFrame, contents: DataFrame) -> DataFrame:
    """``node, content``: what stands for each member, once; ``contents`` may have more nodes, and each many times."""
    nodes = cut_lineage(members.select("node").distinct(), "nodes")
    wanted = join_narrow(contents, nodes, "node", "left_semi")
    return cut_lineage(wanted.groupBy("node").agg(F.first("content").alias("content")), "node-contents")


def _split_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root, main, size``: the members left of the keys where these still lie in several components.

    The first of a key was compared with all others, so it is left out. Of keys with the same members left one
    stays. ``main`` is the key's component with the most members, ``size`` their number.
    """
    placed = join_narrow(members.filter("node <> first").select("key", "node"), roots, "node", "left")
    placed = cut_lineage(placed.select("key", "node", F.coalesce("root", "node").alias("root")), "placed-members")
    # Sets of members are known by two digests of 64 bits and their number.
    sizes = placed.groupBy("key", "root").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two")
    )
    heads = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("n").alias("size"),
        F.bit_xor("one").alias("one"),
        F.bit_xor("two").alias("two"),
    )
    # Equal sets have equal components, so the least key and component are of one set.
    split = heads.filter("parts > 1").groupBy("size", "one", "two").agg(F.min("key").alias("key"), F.min("main").alias("main"))
    split = cut_lineage(split.select("key", "main", "size"), "split-keys")
    return cut_lineage(join_narrow(placed, split, "key"), "split-members")


def _crossing_pairs(inside: DataFrame) -> DataFrame:
    """``a, b``: the pairs of a group's members that lie in two components, each once for all groups."""
    one = inside.select("key", F.col("node").alias("a"), F.col("root").alias("a_root"))
    other = inside.select("key", F.col("node").alias("b"), F.col("root").alias("b_root"))
    return one.join(other, "key").filter("a < b and a_root <> b_root").select("a", "b").distinct()


def block_links(sets: list, roots: list[int], main: int, sides, similarity: float) -> list[tuple[int, int]]:
    """Places of pairs that are alike and join two components, after all pairs across components were considered.

    ``sets`` are arrays of distinct 64-bit digests; pairs on the same side are left out if both sides are there.
    """
    import numpy as np

    parent = {r: r for r in roots}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    lengths = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    holders = owner[np.argsort(element, kind="stable")]
    ends = np.cumsum(np.bincount(element))
    begins = ends - np.bincount(element)
    crossing, out = sides.min() != sides.max(), []
    for n, root in enumerate(roots):
        if root == main:
            continue
        mine = element[starts[n] : starts[n + 1]]
        counts = ends[mine] - begins[mine]
        at = np.arange(counts.sum()) + np.repeat(begins[mine] - (np.cumsum(counts) - counts), counts)
        both = np.bincount(holders[at], minlength=len(sets))
        alike = both >= similarity * (lengths[n] + lengths - both)
        if crossing:
            alike &= sides != sides[n]
        for other in np.nonzero(alike)[0].tolist():
            one, two = find(root), find(roots[other])
            if one != two:
                parent[one] = two
                out.append((n, other))
    return out


def _joining_links(inside: DataFrame, contents: DataFrame, elements: Callable, similarity: float, together: bool) -> DataFrame:
    """``a, b``: links between components of the groups in ``inside``; ``contents`` is ``node, content``, each node once."""
    lengths = cut_lineage(contents.select("node", F.length("content").cast("bigint").alias("chars")), "node-lengths")
    sizes = join_narrow(inside.select("key", "node"), lengths, "node").groupBy("key").agg(
        F.greatest(F.ceil(F.sum("chars") / BLOCK_CHARS), F.ceil(F.count(F.lit(1)) / BLOCK_NODES)).cast("int").alias("blocks")
    )
    sizes = cut_lineage(sizes.withColumn("blocks", F.greatest("blocks", F.lit(1))), "group-blocks")
    mine = F.pmod(F.xxhash64("key", "node"), F.col("blocks")).cast("int")
    dealt = join_narrow(inside, sizes, "key").withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    rows = dealt.join(contents, "node").select("key", "low", "high", "mine", "node", "root", "main", "content")

    def compare(group: pa.Table) -> pa.Table:
        import numpy as np

        nodes, roots = group.column("node").to_pylist(), group.column("root").to_pylist()
        found = []
        if len(set(roots)) > 1:
            texts = group.column("content").to_pylist()
            sets = elements(texts) if together else [elements(x) for x in texts]
            sides = np.asarray(group.column("mine").to_pylist(), np.int64)
            found = block_links(sets, roots, group.column("main")[0].as_py(), sides, similarity)
        ends = zip(*((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in found))
        a, b = ends if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cut_lineage(rows.groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct(), "joining-links")


def linked(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    contents: DataFrame,
    elements: Callable,
    similarity: float,
    together: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The links that make the components, and these: (``a, b``) and (``node, root``).

    ``verify`` keeps the pairs that are alike. ``contents`` has each member once. ``elements`` gives
    the distinct digests of a content whose Jaccard similarity is meant, or, if ``together``, those of
    each content of a list.
    """
    links = cut_lineage(verify(cut_lineage(star_pairs(members), "star-pairs")), "star-links")
    roots = components(links)
    inside = _split_members(members, roots)
    few = cut_lineage(_crossing_pairs(inside.filter(F.col("size") <= PAIR_NODES)), "crossing-pairs")
    near = cut_lineage(verify(few), "crossing-links")
    more = near.unionByName(_joining_links(inside.filter(F.col("size") > PAIR_NODES), contents, elements, similarity, together))
    return links.unionByName(more), merged(roots, more)


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components, ``node, root``, with further links: only those between two of them are walked."""
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        links = links.join(named, side, "left").withColumn(side, F.coalesce(f"{side}_root", side)).drop(f"{side}_root")
    moved = components(links)
    # A root is the smallest of its component before and after, so the smallest stays the name.
    moves = moved.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    kept = join_narrow(roots, moves, "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    fresh = moved.join(roots.select("node"), "node", "left_anti")
    return cut_lineage(kept.unionByName(fresh), "components")


def components(links: DataFrame) -> DataFrame:
    """``node, root``: every linked node with the smallest node of its component.

    Alternates two steps until nothing changes: larger neighbours are tied to the smallest
    neighbour, then smaller ones are. The number of edges never grows, and each step keeps
    the components; nodes with many neighbours are summed up before the shuffle.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = cut_lineage(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(larger.filter("u <> v").distinct(), "edges")
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        smaller = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(smaller.union(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return cut_lineage(roots.union(edges.select(F.col("v"), F.col("v"))).distinct(), "components")
