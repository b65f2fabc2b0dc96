"""Fuzzy line dedup: one line stays of all that are alike, over the whole corpus.

Lines are compared by their sets of character shingles. A line's signature is the least
shingle digest in each of a number of bins (one digest per shingle; an empty bin takes
that of the next filled one). Bands of the signature give
candidates, exact Jaccard similarity of the shingle sets decides, union-find joins
them, and of every component the line that comes first in the stored order stays.

A line shorter than a shingle is its own shingle, so it meets only equal lines. Lines
are known by a 64-bit digest: among n different lines two meet with a chance of about
n * n / 2**65.
Cases: blank lines are layout and stay; null texts stay null and empty ones empty; a
text that loses all its lines is left empty, its row stays; rows that repeat are told
apart by their file and their place in it, so the first keeps its lines; equal first places
can't occur; a text of any length is cut into lines whole, and a very long line is compared
whole; columns other than the text are untouched, whatever their names, but for the count's
own and names that begin with two underscores; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.graph import join_narrow, linked, met_contents, shared_keys
from tremorlake.llm.places import FILE, PLACE, ROW, with_place
from tremorlake.llm.worker import held
from tremorlake.session import cut_lineage

SHINGLE = 8
BANDS, ROWS = 9, 4
SIMILARITY = 0.8
# Characters signed at a time: their digests stay in the processor's cache.
BLOCK = 1 << 18

_SIGNED = f"{FILE} bigint, {ROW} bigint, place int, node bigint, line string, keys array<bigint>"


def _mixed(x):
    """A 64-bit finaliser, in place."""
    import numpy as np

    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def band_keys(lines: list[str], shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
    """Digests of the bands of every line's signature: an array of lines by bands."""
    import numpy as np

    if shingle & (shingle - 1):
        raise ValueError("the length of a shingle must be a power of two")
    bins, gap = bands * rows, shingle - 1
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    # Zeros between lines keep a short line's one shingle apart from its neighbours.
    padding = "\0" * gap
    codes = np.frombuffer((padding.join(lines) + padding * 2).encode("utf-32-le", "surrogatepass"), np.uint32)
    n, total = len(codes), int(lengths.sum()) + gap * len(lines)
    if n <= 4 * BLOCK:
        digests, spare = held("line buffers", lambda: [np.empty(4 * BLOCK, np.uint64) for _ in range(2)])
    else:
        digests, spare = np.empty(n, np.uint64), np.empty(n, np.uint64)
    digests[:n] = codes
    # Digests of runs of 1, 2, 4, ... characters up to a shingle.
    width = 1
    while width < shingle:
        n -= width
        np.multiply(digests[:n], np.uint64(0x9E3779B97F4A7C15 + 2 * width), out=spare[:n])
        spare[:n] += digests[width : n + width]
        digests, spare = spare, digests
        width *= 2
    digests, spare = digests[:total], spare[:total]
    for shift in (32, 29):
        np.right_shift(digests, np.uint64(shift), out=spare)
        digests ^= spare
        digests *= np.uint64(0xD6E8FEB86659FD93)
    # Runs that reach over the end of their line count for none.
    counts = np.maximum(1, lengths - gap)
    over = lengths + gap - counts
    ends = np.cumsum(lengths + gap)
    digests[np.arange(over.sum()) + np.repeat(ends - np.cumsum(over), over)] = none
    np.right_shift(digests, np.uint64(32), out=spare)
    spare *= np.uint64(bins)
    spare >>= np.uint64(32)
    cells = np.repeat(np.arange(0, len(lines) * bins, bins), lengths + gap)
    cells += spare.view(np.int64)
    least = np.full(len(lines) * bins, none)
    np.minimum.at(least, cells, digests)
    least = least.reshape(len(lines), bins)
    # An empty bin takes the value of the next filled one around the circle, mixed with the distance.
    columns = np.ascontiguousarray(least.T)
    carried, distance = np.full(len(lines), none), np.zeros(len(lines), np.uint64)
    filled = np.empty_like(columns)
    for n in range(2 * bins - 1, -1, -1):
        own = columns[n % bins]
        has = own != none
        carried, distance = np.where(has, own, carried), np.where(has, np.uint64(0), distance + np.uint64(1))
        if n < bins:
            filled[n] = carried + distance * np.uint64(0xD6E8FEB86659FD93)
    filled = filled.T
    keys = np.zeros((len(lines), bands), np.uint64)
    for row in range(rows):
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys += _mixed(filled[:, row::rows].copy())
    keys += np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return _mixed(keys).view(np.int64)


def shingles(line: str, shingle: int = SHINGLE) -> set[str]:
    return {line[i : i + shingle] for i in range(max(1, len(line) - shingle + 1))}


def joined_shingles(lines: list[str], shingle: int = SHINGLE):
    """64-bit digests of the shingles of many lines in one array, repeated ones too, and how many each line has."""
    import numpy as np

    if shingle & (shingle - 1):
        raise ValueError("the length of a shingle must be a power of two")
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    padding = "\0" * shingle
    rolled = np.frombuffer((padding.join(lines) + padding * 2).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    # Digests of runs of 1, 2, 4, ... characters up to a shingle. Shifts between the steps keep sums of
    # few multiples from meeting, as one sum of products would let them.
    width = 1
    while width < shingle:
        rolled = rolled[:-width] * np.uint64(0x9E3779B97F4A7C15) + rolled[width:]
        rolled ^= rolled >> np.uint64(32)
        rolled *= np.uint64(0xD6E8FEB86659FD93)
        rolled ^= rolled >> np.uint64(29)
        width *= 2
    counts = np.maximum(1, lengths - shingle + 1)
    begins, firsts = np.cumsum(lengths + shingle) - lengths - shingle, np.cumsum(counts) - counts
    rolled = rolled[np.arange(counts.sum()) + np.repeat(begins - firsts, counts)]
    # A shorter line is told by its length from one that ends with zeros.
    missing = np.maximum(0, shingle - lengths).astype(np.uint64)
    rolled[firsts] += missing * np.uint64(0xD6E8FEB86659FD93)
    return _mixed(rolled), counts


def shingle_sets(lines: list[str], shingle: int = SHINGLE) -> list:
    """Distinct 64-bit digests of each line's shingles, in order."""
    import numpy as np

    digests, counts = joined_shingles(lines, shingle)
    ends, sets = np.cumsum(counts).tolist(), []
    for low, high in zip([0, *ends], ends):
        some = np.sort(digests[low:high])
        sets.append(some[np.concatenate(([True], some[1:] != some[:-1]))])
    return sets


def shingle_digests(line: str, shingle: int = SHINGLE):
    """Distinct 64-bit digests of a line's shingles."""
    return shingle_sets([line], shingle)[0]


def alike_pairs(ones: list[str], others: list[str], similarity: float = SIMILARITY):
    """For each pair of lines whether their sets of shingles are alike, for many pairs at once."""
    import numpy as np

    lines = list(dict.fromkeys(ones + others))
    number = dict(zip(lines, range(len(lines))))
    sets, out = shingle_sets(lines), []
    for one, other in zip(ones, others):
        one, other = sets[number[one]], sets[number[other]]
        n, m = len(one), len(other)
        if min(n, m) < similarity * max(n, m):
            out.append(False)
            continue
        met = np.concatenate((one, other))
        met.sort()
        both = int(np.count_nonzero(met[1:] == met[:-1]))
        out.append(both >= similarity * (n + m - both))
    return out


def alike(one: set, other: set, similarity: float = SIMILARITY) -> bool:
    """Jaccard similarity of at least the bound, worked out in whole terms."""
    if min(len(one), len(other)) < similarity * max(len(one), len(other)):
        return False
    both = len(one & other)
    return both >= similarity * (len(one) + len(other) - both)


def exploded(docs: DataFrame, text: str) -> DataFrame:
    """``__file, __row, place, line, node``: every line that isn't blank."""
    rows = with_place(docs.select(F.col(f"`{text}`").alias("text")))
    lines = rows.select(*PLACE, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.filter(F.col("line").rlike(r"[^ \t\r\x0b\f]")).withColumn("node", F.xxhash64("line"))


def _signed(lines: DataFrame) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n.split()[0] for n in _SIGNED.split(", ")]
        for batch in batches:
            texts = batch.column("line").to_pylist()
            first = 0
            while first < len(texts):
                size, last = 0, first
                while last < len(texts) and size < BLOCK:
                    size += len(texts[last]) + SHINGLE
                    last += 1
                keys = band_keys(texts[first:last])
                offsets = pa.array(range(0, (last - first + 1) * BANDS, BANDS), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int64()))
                head = [batch.column(n).slice(first, last - first) for n in names[:-1]]
                yield pa.RecordBatch.from_arrays([*head, lists], names)
                first = last

    return lines.mapInArrow(sign, _SIGNED)


def _verifier(contents: DataFrame):
    """Keeps the pairs of nodes whose lines are alike."""

    def verify(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(contents.select(F.col("node").alias("b"), F.col("content").alias("b_line")), "b")
        with_both = with_b.join(contents.select(F.col("node").alias("a"), F.col("content").alias("a_line")), "a")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ones, others = batch.column("a_line").to_pylist(), batch.column("b_line").to_pylist()
                first = 0
                while first < len(ones):
                    size, last = 0, first
                    while last < len(ones) and size < BLOCK // 4:
                        size += len(ones[last]) + len(others[last])
                        last += 1
                    keep = pa.array(alike_pairs(ones[first:last], others[first:last]), pa.bool_())
                    yield batch.select(["a", "b"]).slice(first, last - first).filter(keep)
                    first = last

        return with_both.select("a", "b", "a_line", "b_line").mapInArrow(compare, "a bigint, b bigint")

    return verify


def doomed_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``__file, __row, place``: the lines to take out of a stored table."""
    # Lines are kept with their keys, so texts are cut once.
    signed = cut_lineage(_signed(exploded(docs, text).select(*PLACE, "place", "node", "line")), "signed-lines")
    # A line that stands more than once would repeat its bands; the keys are told apart per node later.
    members = shared_keys(signed.select(F.explode("keys").alias("key"), "node"))
    contents = met_contents(members, signed.select("node", F.col("line").alias("content")))
    _, roots = linked(members, _verifier(contents), contents, shingle_sets, SIMILARITY, together=True)
    # Only lines that stand more than once or are linked can lose; all others are left out here.
    times = signed.groupBy("node").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    wanted = times.join(roots, "node", "full").select("node", F.coalesce("root", "node").alias("root"))
    placed = join_narrow(signed.select(*PLACE, "place", "node"), cut_lineage(wanted, "met-nodes"), "node")
    placed = cut_lineage(placed.select(*PLACE, "place", "root"), "met-lines")
    at = F.struct(*PLACE, "place")
    heads = cut_lineage(placed.groupBy("root").agg(F.min(at).alias("stays")), "first-lines")
    return join_narrow(placed, heads, "root").filter(at != F.col("stays")).select(*PLACE, "place")


def line_dedup(docs: DataFrame, text: str = "text", removed: str = "n_removed_lines") -> DataFrame:
    """The documents without the lines that were taken out, and how many those were.

    ``docs`` should be a stored table, as it is read several times and its rows are known by file and place;
    a frame that comes from no file is stored first.
    """
    gone = doomed_lines(docs, text).groupBy(*PLACE).agg(F.collect_set("place").alias("__gone"))
    both = with_place(docs).join(gone, [*PLACE], "left").drop(*PLACE)
    # The places that stay are found by hashing, so texts of very many lines stay linear.
    def spared(parts):
        stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
        return F.array_join(F.transform(stay, lambda n: F.get(parts, n)), "\n")

    parts = F.array(F.split(F.col(f"`{text}`"), "\n"))
    left = F.when(F.size("__gone") > 0, F.transform(parts, spared)[0]).otherwise(F.col(f"`{text}`"))
    counted = F.coalesce(F.size("__gone"), F.lit(0)).cast("long")
    return both.withColumn(removed, counted).withColumn(text, left).drop("__gone")


def op2_line_dedup(spark, sf_dir):
    """Every document without the lines that stand elsewhere first, and how many went.

    Null texts stay null and a text that loses all lines is left empty; an empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs)
