"""A Merkle manifest of a table: a digest tree per source, one over the sources, and a version per tampered leaf.

Every row is a leaf, the SHA-256 of its fields. Within a source the leaves ascend by id;
while more than one node remains, each run of three becomes the digest of its hexadecimal
digests. The trees' tops, ordered by source, are the leaves of the last tree.

A tree of any size is cut into aligned blocks of 3**6 nodes. A block is the unit of work: its
inner nodes are hashed in one task, its top is a leaf of the next level of blocks, and so on
in rounds until one node remains. A tampered leaf is a new version of its block that
shares every node but the leaf's ancestors, which are copied. Versions go on above their block
along the path that the rounds above have found for it, so no version holds more than the
nodes from its leaf to the root, and no task more than a block.

Cases: null fields are ``-`` in a leaf; a null id comes before all others and is never tampered
with; a null source comes before all others and is a source of its own; rows that repeat an id
are ordered by their leaves, and equal rows are interchangeable; empty and very long texts
are values like others; a table of one row has that leaf for subroot and root, and the
digest of nothing for a proof; an empty table gives no row; extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.operators.ranking import join_with_nulls, running_before
from tremorlake.session import cut_lineage

ARITY, DEPTH = 3, 6
BLOCK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Shards whose totals one task adds up.
_FAN_OUT = 4096

_STEPS = "array<struct<before:binary,after:binary>>"
_MANIFEST = (
    "tree bigint, doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, each with its length in bytes before it."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined(nodes: Sequence[bytes]) -> bytes:
    """Digests one after the other, in hexadecimal."""
    return b"".join(n.hex().encode() for n in nodes)


def parent(before: bytes, node: bytes, after: bytes) -> bytes:
    import hashlib

    return hashlib.sha256(before + node.hex().encode() + after).digest()


class PathTree:
    """The nodes of one block, level by level, and versions that share them."""

    def __init__(self, leaves: list[bytes], levels: int):
        import hashlib

        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            runs = (below[i : i + ARITY] for i in range(0, len(below), ARITY))
            self.levels.append([hashlib.sha256(joined(r)).digest() for r in runs])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def steps(self, at: int) -> list[tuple[bytes, bytes]]:
        """The siblings before and after each node on the way up from a leaf, in hexadecimal."""
        found = []
        for level in self.levels[:-1]:
            first = at - at % ARITY
            found.append((joined(level[first:at]), joined(level[at + 1 : first + ARITY])))
            at //= ARITY
        return found


def version(leaf: bytes, steps: Sequence[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with this leaf does not share: the leaf's own path, copied up to the top."""
    path = [leaf]
    for before, after in steps:
        path.append(parent(before, path[-1], after))
    return path


def levels_in_block(n: int) -> int:
    """Levels that a block of a tree of ``n`` leaves has above its leaves: all of them if the tree goes on above it."""
    if n > BLOCK:
        return DEPTH
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _block_tree(group: pa.Table) -> PathTree:
    """The tree of a group of rows (``tree, block, pos, n, node``) that are one block, in order of ``pos``."""
    return PathTree(group.column("node").to_pylist(), levels_in_block(group.column("n")[0].as_py()))


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


def _tops(nodes: DataFrame) -> DataFrame:
    """``tree, pos, n, node``: the tops of the blocks, which are the leaves of the level above."""

    def top(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        n = group.column("n")[0].as_py()
        above = -(-n // BLOCK)
        block = group.column("block")[0].as_py()
        tree = group.column("tree")[0].as_py()
        return pa.table(
            {
                "tree": pa.array([tree], pa.int64()),
                "pos": pa.array([block], pa.int64()),
                "n": pa.array([above], pa.int64()),
                "node": pa.array([_block_tree(group).top], pa.binary()),
            }
        )

    schema = "tree bigint, pos bigint, n bigint, node binary"
    rows = _blocks(nodes).select("tree", "block", "pos", "n", "node")
    return cut_lineage(rows.groupBy("tree", "block").applyInArrow(top, schema), "block-tops")


def _paths(nodes: DataFrame) -> DataFrame:
    """``tree, pos, block, steps``: every node's siblings on the way up to the top of its block."""

    def climb(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        tree = _block_tree(group)
        steps = [[{"before": b, "after": a} for b, a in tree.steps(i)] for i in range(group.num_rows)]
        kind = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
        return group.select(["tree", "pos", "block"]).append_column("steps", pa.array(steps, kind))

    rows = _blocks(nodes).select("tree", "block", "pos", "n", "node")
    return rows.groupBy("tree", "block").applyInArrow(climb, f"tree bigint, pos bigint, block bigint, steps {_STEPS}")


def climbed(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For nodes ``tree, pos, n, node``: (``tree, pos, steps``) up to each tree's top, and (``tree, node``), the tops.

    Rounds of blocks: each round has one node for 729 of the round before, so a tree of
    all rows there can be takes four.
    """
    rounds = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        rounds.append(_tops(rounds[-1]))
        largest = -(-largest // BLOCK)
    above = None
    for level in reversed(rounds[:-1]):
        own = _paths(level)
        if above is not None:
            upper = above.select("tree", F.col("pos").alias("block"), F.col("steps").alias("upper"))
            own = own.join(upper, ["tree", "block"]).withColumn("steps", F.concat("steps", "upper"))
        above = cut_lineage(own.select("tree", "pos", "steps"), "node-paths")
    if above is None:
        above = nodes.select("tree", "pos", F.array().cast(_STEPS).alias("steps"))
    return above, rounds[-1].select("tree", "node")


def _placed(leaves: DataFrame) -> DataFrame:
    """``tree, pos, n`` for every leaf: the number of its source, its place there, and the leaves of the source.

    Rows are dealt out and sorted by range, so a source of any size is spread over tasks,
    and places follow from the sizes of (shard, source) groups.
    """
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id())
    order = ("source", "doc_id", "leaf", "tie")
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    # Numbers ascend over shards and within them.
    ranged = ranged.withColumns({"shard": F.spark_partition_id(), "number": F.monotonically_increasing_id()})
    stored = cut_lineage(ranged, "ordered-leaves")
    groups = stored.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("first"))
    groups = cut_lineage(groups.withColumn("range", F.floor(F.col("shard") / _FAN_OUT)), "shard-sources")
    within = running_before(groups, ["rows"], ["shard"], ["source"], ["range"])
    sources = groups.groupBy("source").agg(
        F.sum("rows").alias("n"), F.min("first").alias("begin"), F.min("shard").alias("shard"), F.lit(1).alias("one")
    )
    sources = sources.withColumn("range", F.floor(F.col("shard") / _FAN_OUT))
    numbered = running_before(sources, ["one"], ["begin"], [], ["range", "shard"])
    trees = numbered.select("source", "n", F.col("one_before").cast("bigint").alias("tree"))
    known = join_with_nulls(within.select("shard", "source", "first", "rows_before"), trees, ["source"])
    known = cut_lineage(known, "shard-places")
    pos = F.col("rows_before") + F.col("number") - F.col("first")
    return join_with_nulls(stored, known, ["shard", "source"]).select(
        "tree", pos.cast("bigint").alias("pos"), "n", "doc_id", F.col("leaf").alias("node"), "tampered"
    )


def _manifest(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block's leaves and the steps above it: proofs, versions and roots."""
    import hashlib

    names = [f.split()[0] for f in _MANIFEST.split(", ")]
    left = left.sort_by("pos")
    tree = _block_tree(left)
    upper, last = ([(s["before"], s["after"]) for s in right.column(c)[0].as_py()] for c in ("steps", "source_steps"))
    subroot = version(tree.top, upper)[-1]
    root = version(subroot, last)[-1]
    rows = []
    columns = (left.column(c).to_pylist() for c in ("tree", "doc_id", "node", "tampered"))
    for at, (number, doc_id, leaf, tampered) in enumerate(zip(*columns)):
        steps = [*tree.steps(at), *upper, *last]
        proof = hashlib.sha256(b"".join(b + a for b, a in steps)).hexdigest()
        folded = version(leaf if tampered is None else tampered, steps)[-1]
        rows.append((number, doc_id, leaf.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root))
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def manifest(
    docs: DataFrame, key: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS, tampered: Column | None = None
) -> DataFrame:
    """The manifest of a table: leaf, subroot, root and digest of the proof for every row.

    ``tampered`` is the leaf to try in a row's place, null where there is none; the version
    it makes ends in ``folded_root``, which equals the root if the leaf is sound.
    """
    rows = docs.select(
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{key}`").cast("bigint").alias("doc_id"),
        leaf_of([F.col(f"`{f}`") for f in fields]).alias("leaf"),
        (F.lit(None).cast("binary") if tampered is None else tampered).alias("tampered"),
    )
    # The texts are read and hashed once; all that follows is as narrow as this table.
    leaves = cut_lineage(_placed(cut_lineage(rows, "leaves")), "leaves")
    tops = _tops(leaves)
    paths, subroots = climbed(tops)
    number, zero = F.lit(subroots.count()).cast("bigint"), F.lit(0).cast("bigint")
    trees = subroots.select(zero.alias("tree"), F.col("tree").alias("pos"), number.alias("n"), "node")
    source_paths, _ = climbed(cut_lineage(trees, "subroots"))
    above = source_paths.select(F.col("pos").alias("tree"), F.col("steps").alias("source_steps"))
    upper = paths.join(above, "tree").select("tree", F.col("pos").alias("block"), "steps", "source_steps")
    blocks = _blocks(leaves).groupBy("tree", "block")
    out = blocks.cogroup(upper.groupBy("tree", "block")).applyInArrow(_manifest, _MANIFEST)
    return out.drop("tree")


def without_newlines(text: str = "text", key: str = "doc_id", fields: Sequence[str] = FIELDS) -> Column:
    """The leaf of a row whose text lost its line ends, for rows whose id has an even CRC-32."""
    cut = F.replace(F.col(f"`{text}`"), F.lit("\n"), F.lit(""))
    changed = [cut if f == text else F.col(f"`{f}`") for f in fields]
    even = F.crc32(F.col(f"`{key}`").cast("bigint").cast("string").cast("binary")) % 2 == 0
    return F.when(even, leaf_of(changed))


def op13_merkle(spark, sf_dir):
    """The manifest of all documents, and for every second one the version in which its text lost its line ends.

    Null ids are never tampered with; an empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return manifest(docs, tampered=without_newlines())


# The polynomial of CRC-32, bit by bit, as DuckDB has no such function.
_CRC_BIT = "xor(c >> 1, 3988292384 * (c & 1))"
_CRC_BYTE = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: {_CRC_BIT})"


def _leaf_sql(text: str) -> str:
    fields = [text if f == "text" else f for f in FIELDS]
    parts = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


OP13_SQL = f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)), lambda c, b: {_CRC_BYTE}), 4294967295::BIGINT) % 2 = 0
      THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered
  FROM documents
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM rows_
), tree AS (
  SELECT 0 AS lvl, s, pos, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lvl + 1, s, pos // 3, (max(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lvl, s, pos // 3
), tops AS (
  SELECT s AS pos, node, count(*) OVER () AS n FROM tree WHERE n = 1
), last_tree AS (
  SELECT 0 AS lvl, pos, n, node FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM last_tree WHERE n > 1 GROUP BY lvl, pos // 3
), every AS (
  SELECT 0 AS part, lvl, s, pos, node FROM tree WHERE n > 1
  UNION ALL SELECT 1, lvl, 0, pos, node FROM last_tree WHERE n > 1
), siblings AS (
  SELECT a.part, a.lvl, a.s, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM every a JOIN every b ON a.part = b.part AND a.lvl = b.lvl AND a.s = b.s AND a.pos // 3 = b.pos // 3 GROUP BY ALL
), heights AS (
  SELECT s, max(lvl) AS top FROM tree GROUP BY s
), up AS (
  SELECT l.doc_id, l.s, l.pos, 0 AS step, coalesce(l.tampered, l.leaf) AS node, '' AS proof, l.s AS t, l.pos AS at FROM leaves l
  UNION ALL
  SELECT u.doc_id, u.s, u.pos, step + 1, sha256(x.before || u.node || x.after), proof || x.before || x.after, t,
    CASE WHEN step + 1 = h.top THEN u.s ELSE u.at // 3 END
  FROM up u JOIN heights h ON u.s = h.s
  JOIN siblings x ON CASE WHEN step < h.top THEN x.part = 0 AND x.lvl = step AND x.s = u.s AND x.pos = u.at
    ELSE x.part = 1 AND x.lvl = step - h.top AND x.pos = CASE WHEN h.top = 0 AND step = 0 THEN u.s ELSE u.at END END
), ends AS (
  SELECT s, pos, max_by(node, step) AS node, max_by(proof, step) AS proof FROM up GROUP BY s, pos
)
SELECT l.doc_id, l.leaf, t.node AS subroot, r.node AS root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = r.node AS verified
FROM leaves l JOIN ends e ON l.s = e.s AND l.pos = e.pos JOIN tops t ON t.pos = l.s CROSS JOIN (SELECT node FROM last_tree WHERE n = 1) r"""
