"""Exact top-k inner products over an impact-ordered index, score at a time.

Rows are cut into blocks of a bounded number and queries into blocks of a bounded
number; a task has one of each. It orders the rows of its block by impact in every
dimension, cut into segments of equal quantised impact. A query takes the segments of
all dimensions in descending order of what they can add and sums them up per row. It
stops when what is left can't lift any other row over the k-th best sum so far, and
scores all rows that may still be members exactly. A row's sum starts from the least its
dimensions can give, so all impacts are positive and every sum is a lower bound.

Cases: vectors that are null or hold null or non-finite components take no part; vectors
of another length than the query's are no candidates; the query's own id is no
candidate, however often it occurs; other repeated rows are candidates each; a query
row that is repeated as a whole is asked once, and two different ones under one id are
asked together: the best of both stand in the answer; ties go to the smaller id, null
ids last; fewer than k candidates are all returned; an empty table gives no row; extra
columns are left behind. Components may be of any size: a block whose products could pass
63 bits is searched in whole numbers without a limit, in the same way. A component that
passes 63 bits once scaled counts as the end of the 64-bit range on its side. A score
beyond that range has its exact rank and a null as its score.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
BLOCK_ROWS = 16384
BLOCK_QUERIES = 1024
# Impacts are quantised to this many levels per dimension.
LEVELS = 64
# Each round takes the segments that can add at least this share of the round before.
_STEP = 0.45

# A score in parts that order as it does, and itself where it fits.
_PARTS = ("high", "middle", "low")
RESULT = "query_id bigint, vec_id bigint, score bigint, high bigint, middle bigint, low bigint"
_WORD = 48


def quantised(vector: str | Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str | Column) -> Column:
    """Not null, and all components finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(F.transform(vector, lambda x: x.cast("double")), bad), F.lit(False))


def _parts(score: int) -> tuple[int | None, int, int, int]:
    mask = (1 << _WORD) - 1
    fits = -(1 << 63) <= score < 1 << 63
    return score if fits else None, score >> 2 * _WORD, score >> _WORD & mask, score & mask


class ImpactIndex:
    """Rows of one block, ordered by impact in each dimension; 64-bit numbers or Python's own."""

    def __init__(self, ids, vectors):
        import numpy as np

        # Ids ascend and nulls (given as the largest number) are last, so ties fall by place.
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, self.dims = self.vectors.shape
        self.low = self.vectors.min(axis=0) if n else np.zeros(self.dims, np.int64)
        span = (self.vectors.max(axis=0) - self.low) if n else self.low
        self.width = span // LEVELS + 1
        above = self.vectors - self.low
        levels = (above // self.width).astype(np.int64)
        self.top = span // self.width
        self.span = span
        # Rows by descending component, the components above the least, and where each level starts.
        self.order = np.argsort(-self.vectors, axis=0, kind="stable").T.astype(np.int32).copy()
        self.above = np.take_along_axis(above, self.order.T.astype(np.int64), axis=0).T.copy()
        self.counts = [np.bincount(levels[:, d], minlength=LEVELS + 1)[::-1].cumsum()[::-1] for d in range(self.dims)]
        self.n = n

    def top_k(self, query, own: int | None, k: int):
        """Places and exact scores of the k best rows, ties by place."""
        import numpy as np

        n, sums = self.n, np.zeros(self.n, self.vectors.dtype)
        weight = np.abs(query)
        up = query > 0
        least = np.where(up, query * self.low, query * (self.low + self.span)).sum()
        done = np.zeros(self.dims, np.int64)  # rows taken from the front, or from the back for negative weights
        left = weight * self.span  # the most that an untaken row can get from each dimension
        mine = slice(*np.searchsorted(self.ids, [own, own], "left")) if own is None else slice(
            np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
        )
        others = n - (mine.stop - mine.start)
        if others <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bound = left.max() if self.dims else 0
        while left.sum() > 0:
            bound = bound * _STEP
            for d in np.nonzero(left > bound)[0]:
                w = weight[d]
                counts, size = self.counts[d], self.width[d]
                # The lowest quantised impact that can still add the bound.
                level = min(int(bound // w) // int(size), int(self.top[d]))
                if up[d]:
                    upto = int(counts[level])
                    rows, add = self.order[d, done[d] : upto], w * self.above[d, done[d] : upto]
                    left[d] = w * (level * size - 1) if level else 0
                else:
                    # From the back the impact is what the component lacks to the most.
                    lack = int(self.span[d]) - level * int(size)
                    start = int(np.searchsorted(-self.above[d], -lack, "left"))
                    rows = self.order[d, start : n - done[d]]
                    add = w * (self.span[d] - self.above[d, start : n - done[d]])
                    upto = n - start
                    left[d] = w * (level * size - 1) if level else 0
                    if upto == n:
                        left[d] = 0
                done[d] = max(done[d], upto)
                if upto == n:
                    left[d] = 0
                sums[rows] += add
            rest = left.sum()
            if others > k:
                sums_of_others = np.delete(sums, mine)
                kth = np.partition(sums_of_others, others - k)[others - k]
                possible = np.count_nonzero(sums_of_others + rest >= kth)
                if possible <= max(8 * k, n // 16):
                    break
        rest = left.sum()
        sums[mine] = -(rest + 1)
        if others > k:
            kth = np.partition(sums, n - k)[n - k]
            members = np.nonzero(sums + rest >= kth)[0]
        else:
            members = np.nonzero(sums >= 0)[0]
        scores = self.vectors[members] @ query
        assert not rest and len(members) == 0 or (scores - least >= sums[members]).all()
        best = np.lexsort((members, -scores))[:k]
        return members[best], scores[best]


_NULL_ID = (1 << 63) - 1


def _matrix(vectors: pa.ChunkedArray, dims: int):
    import numpy as np

    flat = vectors.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else flat
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.int64).reshape(len(vectors), dims)


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of every query."""
    pick = [F.col(f"`{key}`").cast("bigint").alias("id"), quantised(f"`{vector}`", scale).alias("v")]
    whole = rows.filter(usable(f"`{vector}`")).select(*pick)
    asked = queries.filter(usable(f"`{vector}`") & F.col(f"`{key}`").isNotNull()).select(*pick).distinct()
    row_blocks = max(1, -(-rows.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // block_queries))
    # The tie lets equal rows spread over blocks.
    row_block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(row_blocks))
    query_block = F.pmod(F.xxhash64("id", "v"), F.lit(query_blocks))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    left = whole.select("id", "v", F.size("v").alias("dims"), row_block.alias("block")).withColumn("part", numbers(query_blocks))
    right = asked.select("id", "v", F.size("v").alias("dims"), query_block.alias("part")).withColumn("block", numbers(row_blocks))

    def search(block: pa.Table, some: pa.Table) -> pa.Table:
        import numpy as np

        out_query, out_id, out_parts = [], [], []
        if block.num_rows and some.num_rows:
            dims = block.column("dims")[0].as_py()
            vectors, wanted = _matrix(block.column("v"), dims), _matrix(some.column("v"), dims)
            most = max(abs(int(f(x))) for x in (vectors, wanted) for f in (np.min, np.max)) if dims else 0
            if most * most * max(1, dims) * 4 >= 1 << 63:
                vectors, wanted = vectors.astype(object), wanted.astype(object)
            ids = np.array([_NULL_ID if i is None else i for i in block.column("id").to_pylist()], np.int64)
            index = ImpactIndex(ids, vectors)
            for query_id, query in zip(some.column("id").to_pylist(), wanted):
                places, scores = index.top_k(query, query_id, k)
                out_query += [query_id] * len(places)
                out_id += [None if i == _NULL_ID else int(i) for i in index.ids[places]]
                out_parts += [_parts(s) for s in scores.tolist()]
        columns = [out_query, out_id, *(zip(*out_parts) if out_parts else [[]] * 4)]
        arrays = [pa.array(list(x), pa.int64()) for x in columns]
        return pa.Table.from_arrays(arrays, ["query_id", "vec_id", "score", *_PARTS])

    keys = ("dims", "block", "part")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(*[F.desc(c) for c in _PARTS], F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_topk(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP7_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 100 = 0 AND r.vec_id IS DISTINCT FROM q.vec_id AND len(q.v) = len(r.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
