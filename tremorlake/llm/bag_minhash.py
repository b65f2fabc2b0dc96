"""Near-duplicate documents by BagMinHash over bags of word shingles.

A document is a bag: each run of five words with the number of times it occurs. Its
signature is unbiased for the weighted Jaccard similarity of two bags, the sum of the
smaller weights over the sum of the larger. Every shingle owns a Poisson process over
time and weight: a point has a time, a place in the signature and a height, and counts
for the weights above its height. The signature holds the first time at each place. So
two bags agree at a place with the probability of their similarity. The weight axis is
cut into the levels [0,1), [1,2), [2,4), [4,8), ... each with a process of its own whose
rate is its length. A weight takes all levels below it whole and the points of the level
it lies in up to its height. Whole numbers make that exact. Points are drawn in order of
time, and a process ends as soon as its time is beyond the latest of the signature, so
a bag of n shingles costs about n points and a few hundred more, whatever its weights.

Bands of the signature give candidates; they are verified by the exact overlap of the
bags, and joined to classes by union-find.

Cases: shorter texts are one run of all their words; texts without any word are copies
of each other; a null text is an empty one; equal texts are told by a digest before
anything is compared; rows that repeat an id are rows of their own; a null id stays
null, and comes last in the choice of a class's id; texts of any length are signed and
compared whole; extra columns stay behind in ``near_duplicates`` and are kept by
``representatives``, whatever their names but for ``__file`` and ``__row``; an empty table stays empty.
Texts are known by a 64-bit digest of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.graph import join_narrow, linked, met_contents, shared_keys
from tremorlake.llm.places import FILE, PLACE, ROW, with_place
from tremorlake.llm.words import mixed, run_digests
from tremorlake.session import cut_lineage

SHINGLE = 5
BANDS, ROWS = 25, 5
SIMILARITY = 0.8
# Characters of text whose bags are drawn together.
BLOCK = 1 << 22

_GOLDEN = 0x9E3779B97F4A7C15
_SIGNED = f"{FILE} bigint, {ROW} bigint, id bigint, node bigint, keys array<bigint>"


def _levels(doc, element, weight):
    """The processes that each weighted element takes part in: one per level up to its weight."""
    import numpy as np

    top = np.where(weight > 1, np.floor(np.log2(np.maximum(weight - 1, 1))).astype(np.int64) + 1, 0)
    level = np.arange(top.sum() + len(top)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    doc, element, weight = (np.repeat(x, top + 1) for x in (doc, element, weight))
    low = np.where(level > 0, np.left_shift(1, np.maximum(level - 1, 0)), 0)
    length = np.maximum(low, 1)
    seed = element ^ mixed((level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return doc, seed, weight, low, length


def signatures(docs, elements, weights, count: int, size: int = BANDS * ROWS):
    """First times per document and place: an array of ``count`` by ``size``.

    ``docs`` numbers the document of each element; elements are 64-bit digests.
    """
    import numpy as np

    first = np.full(count * size, np.inf)
    doc, seed, weight, low, length = _levels(np.asarray(docs, np.int64), elements, np.asarray(weights, np.int64))
    time, n = np.zeros(len(doc)), 0
    unit = 1.0 / (1 << 53)
    while len(doc):
        n += 1
        draw = mixed(seed + np.uint64(n * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * unit) / length
        more = mixed(draw ^ np.uint64(0xA0761D6478BD642F))
        place = ((more >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        height = low + ((more & np.uint64(0xFFFFFFFF)).astype(np.float64) * length / 2.0**32).astype(np.int64)
        counts = height < weight
        np.minimum.at(first, doc[counts] * size + place[counts], time[counts])
        latest = first.reshape(count, size).max(axis=1)
        on = time < latest[doc]
        doc, seed, weight, low, length, time = (x[on] for x in (doc, seed, weight, low, length, time))
    return first.reshape(count, size)


def bag(text: str, shingle: int = SHINGLE):
    import numpy as np

    return np.unique(run_digests(text, shingle), return_counts=True)


def band_keys(texts: list[str], shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
    """Digests of the bands of each text's signature; texts without words have none."""
    import numpy as np

    bags = [bag(t, shingle) for t in texts]
    docs = np.repeat(np.arange(len(texts)), [len(b[0]) for b in bags])
    elements = np.concatenate([b[0] for b in bags]) if bags else np.empty(0, np.uint64)
    weights = np.concatenate([b[1] for b in bags]) if bags else np.empty(0, np.int64)
    times = signatures(docs, elements, weights, len(texts), bands * rows).view(np.uint64)
    keys = np.zeros((len(texts), bands), np.uint64)
    for row in range(rows):
        keys *= np.uint64(_GOLDEN)
        keys += mixed(times[:, row::rows].copy())
    keys += np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    has = np.array([len(b[0]) > 0 for b in bags], bool)
    return mixed(keys).view(np.int64), has


def bag_elements(text: str, shingle: int = SHINGLE):
    """Digests of a bag as a set: an element for each occurrence, so that the Jaccard similarity of sets is the bags' own."""
    import numpy as np

    values, counts = bag(text, shingle)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mixed(np.repeat(values, counts) + nth.astype(np.uint64) * np.uint64(_GOLDEN))


def alike(one, other, similarity: float = SIMILARITY) -> bool:
    """Weighted Jaccard similarity of two bags, exactly."""
    import numpy as np

    n, m = int(one[1].sum()), int(other[1].sum())
    if min(n, m) < similarity * max(n, m):
        return False
    _, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(one[1][i], other[1][j]).sum())
    return both >= similarity * (n + m - both)


def _named(docs: DataFrame, key: str | None, text: str) -> DataFrame:
    """``__file, __row, id, node, text``: where a row is stored, its id, the digest of its words, and its text."""
    words = F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return with_place(docs).select(
        *PLACE,
        (F.col(f"`{key}`") if key else F.lit(None)).cast("bigint").alias("id"),
        F.xxhash64(F.trim(words)).alias("node"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def _signed(named: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first = batch.column("text").to_pylist(), 0
            while first < len(texts):
                size, last = 0, first
                while last < len(texts) and size < BLOCK:
                    size += len(texts[last])
                    last += 1
                keys, has = band_keys(texts[first:last])
                rows = pa.array([k.tolist() if h else [] for k, h in zip(keys, has)], pa.list_(pa.int64()))
                names = [n.split()[0] for n in _SIGNED.split(", ")]
                head = [batch.column(n).slice(first, last - first) for n in names[:-1]]
                yield pa.RecordBatch.from_arrays([*head, rows], names)
                first = last

    return named.mapInArrow(sign, _SIGNED)


def _verifier(contents: DataFrame):
    """Keeps the pairs of nodes whose texts are alike."""

    def verify(pairs: DataFrame) -> DataFrame:
        texts = contents.withColumnRenamed("content", "text")
        with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        with_both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, its = None, None
            for batch in batches:
                keep = []
                for n in range(batch.num_rows):
                    a = batch.column("a")[n].as_py()
                    if a != last:
                        last, its = a, bag(batch.column("a_text")[n].as_py())
                    keep.append(alike(its, bag(batch.column("b_text")[n].as_py())))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return with_both.select("a", "b", "a_text", "b_text").mapInArrow(compare, "a bigint, b bigint")

    return verify


def classes(docs: DataFrame, key: str | None = "doc_id", text: str = "text") -> DataFrame:
    """``__file, __row, id, root``: every row of a stored table, its id, and the class it belongs to."""
    named = _named(docs, key, text)
    signed = cut_lineage(_signed(named), "signed-texts")
    rows = signed.select(F.explode("keys").alias("key"), "node")
    members = shared_keys(rows)
    contents = met_contents(members, named.select("node", F.col("text").alias("content")))
    _, roots = linked(members, _verifier(contents), contents, bag_elements, SIMILARITY)
    placed = join_narrow(signed.select(*PLACE, "id", "node"), roots, "node", "left")
    return cut_lineage(placed.select(*PLACE, "id", F.coalesce("root", "node").alias("root")), "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, class_size``: a row per document; the class has the smallest id of its members."""
    placed = classes(docs, key, text).select(F.col("id").alias("doc_id"), "root")
    met = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    # Most classes have one member; only the others are joined.
    shared = cut_lineage(met.filter("class_size > 1"), "shared-classes")
    joined = join_narrow(placed, shared, "root", "left")
    own = F.col("class_size").isNull()
    return joined.select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def representatives(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of every class, with all its columns: the first by file and place."""
    placed, at = classes(docs, None, text), F.struct(*PLACE)
    met = placed.groupBy("root").agg(F.min(at).alias("stays"), F.count(F.lit(1)).alias("size"))
    shared = cut_lineage(met.filter("size > 1").select("root", "stays"), "shared-classes")
    gone = join_narrow(placed, shared, "root").filter(at != F.col("stays")).select(*PLACE)
    return join_narrow(with_place(docs), cut_lineage(gone, "gone"), [*PLACE], "left_anti").drop(*PLACE)


def op4_near_dedup(spark, sf_dir):
    """Every document's class of near copies: the class's smallest id and its size.

    Null texts are empty ones and copies of each other; an empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
