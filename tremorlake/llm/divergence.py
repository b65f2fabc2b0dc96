"""Source divergence audit: how far the sources of a language are from each other, and in which terms.

Every (language, source) group has a smoothed share p of each kept term of its language, in whole
billionths. The divergence of a group from a peer with shares q is the sum over all kept
terms of f(p, q) = floor((p - q)**2 / q).

Rows of the group-by-term matrix are multiplied with the term-major index row by row: a group
goes through its own terms, and each term's postings add to a dense accumulator with a place per
peer. No pair of postings is ever written. A term that a group or a peer lacks has the
smoothed share of nothing there, so the sums start from that baseline,

    sum over all terms of f(p0, q0)
    + sum over the group's terms of f(p, q0) - f(p0, q0)
    + sum over the peer's terms of f(p0, q) - f(p0, q0)
    + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0).

Only the last line needs postings of both sides. The lines above depend on a term only
through its share, of which a group has few different ones, so they come from
each group's counts of shares. The index is cut into blocks of terms, whatever their
source, so a source of any size is spread over tasks; a task holds one block and one accumulator.

All sums are exact: shares are below 2**31, so a square is below 2**62, and the shares of a group
add up to a billion and the number of terms, so each of the four sums is below 2**62 while a
language has fewer than a billion kept terms; sums of blocks are decimals.

Cases: null texts, languages and sources are empty ones; a group without terms takes part with
the baseline alone; a language without kept terms has zero for every pair; a language of one
source has no pairs; equal values are ranked by the item; rows that repeat an id are documents of
their own; texts of any length are counted whole; extra columns are left behind; an empty table
gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.session import cut_lineage

# Documents of a language that must hold a term; the best terms that are reported of a group.
LEAST_DOCUMENTS, BEST_TERMS = 3, 200
SCALE = 1_000_000_000
# Terms that a task counts before it hands them on; postings of a block; pairs at once; groups of a task.
HELD, POSTINGS, PAIRS, ROWS = 400_000, 200_000, 1 << 20, 64

_COUNTED = "lang string, source string, term string, n bigint, docs bigint"
_PARTS = "lang string, mine bigint, peer bigint, part bigint"
# A-Z to lower case, all other ASCII but a-z to white space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, with A-Z in lower case."""
    # Only ASCII white space divides bytes, and all of it has become a space.
    return text.translate(_TABLE).split()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term, per group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: dict) -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                names = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                sizes = [pa.array(x, pa.int64()) for x in (list(n.values()), [docs[t] for t in n])]
                yield pa.RecordBatch.from_arrays([*names, terms, *sizes], ["lang", "source", "term", "n", "docs"])

        held, size = {}, 0
        for rows in batches:
            texts = rows.column(2).cast(pa.binary())
            for lang, source, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts):
                terms = terms_of(text.as_py())
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(terms)
                docs.update(set(terms))
                size += len(n)
                if size > HELD:
                    yield from batch(held)
                    held, size = {}, 0
        yield from batch(held)

    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), empty).alias(c) for c in (lang, source, text)])
    counted = rows.mapInArrow(count, _COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in billionths, exactly; 1 where there are no terms at all."""
    scaled = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    size = F.nullif(total + terms, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.coalesce(F.call_function("div", scaled, size), F.lit(0))


def _f(p, q):
    """Of whole numbers or arrays of them."""
    return (p - q) * (p - q) // q


def scattered(term, mine, share, base, peers: int) -> Iterator[tuple[int, "object"]]:
    """For every group of a block its accumulator, a place per peer.

    The arrays have a place per posting: the term's number, the group's number, the share, and the group's
    share of nothing. Postings are ordered by term.
    """
    import numpy as np

    starts = np.concatenate(([0], np.nonzero(np.diff(term))[0] + 1, [len(term)]))
    first, last = np.repeat(starts[:-1], np.diff(starts)), np.repeat(starts[1:], np.diff(starts))
    by_group = np.argsort(mine, kind="stable")
    bounds = np.concatenate(([0], np.nonzero(np.diff(mine[by_group]))[0] + 1, [len(mine)]))
    for low, high in zip(bounds[:-1], bounds[1:]):
        row = by_group[low:high]
        sums = np.zeros(peers, np.int64)
        sizes = last[row] - first[row]
        # A slice of the row's terms at a time, so that no more than so many postings are gathered.
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(PAIRS, int(sizes.sum()) + PAIRS, PAIRS), side="left")
        for some in np.split(row, np.unique(cuts[cuts < len(row)])):
            n = last[some] - first[some]
            at = np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            p, p0 = np.repeat(share[some], n), base[row[0]]
            q, q0 = share[at], base[at]
            np.add.at(sums, mine[at], _f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0))
        yield int(mine[row[0]]), sums


def _common(postings: DataFrame) -> DataFrame:
    """The part of terms that both sides hold, per pair of groups and block of terms."""

    def multiply(block: pa.Table) -> pa.Table:
        import numpy as np

        term = block.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(term, kind="stable")
        mine, share, base = (block.column(c).to_numpy()[order] for c in ("mine", "share", "base"))
        out = []
        for group, sums in scattered(term[order], mine, share, base, int(mine.max()) + 1):
            peers = np.nonzero(sums)[0]
            peers = peers[peers != group]
            out.append((np.full(len(peers), group, np.int64), peers, sums[peers]))
        columns = [np.concatenate(c) for c in zip(*out)]
        lang = pa.array([block.column("lang")[0].as_py()] * len(columns[0]), pa.string())
        return pa.table([lang, *map(pa.array, columns)], ["lang", "mine", "peer", "part"])

    rows = postings.select("lang", "block", "term", "mine", "share", "base")
    return rows.groupBy("lang", "block").applyInArrow(multiply, _PARTS)


def _baselines(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The other parts, per pair of groups: from each group's counts of shares and its peers' shares of nothing."""

    def add(mine: pa.Table, peers: pa.Table) -> pa.Table:
        import numpy as np

        peers = peers.sort_by("mine")
        number, base, held, terms = (peers.column(c).to_numpy() for c in ("mine", "base", "held", "terms"))
        mine = mine.sort_by("mine")
        groups, share, times = (mine.column(c).to_numpy() for c in ("mine", "share", "times"))
        out = []
        bounds = np.concatenate(([0], np.nonzero(np.diff(groups))[0] + 1, [len(groups)]))
        for low, high in zip(bounds[:-1], bounds[1:]):
            own = groups[low]
            at = np.searchsorted(number, own)
            as_group, as_peer = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            for p, n in zip(share[low:high], times[low:high]):
                if n:
                    as_group += n * _f(p, base)
                    as_peer += n * _f(base, p)
            # The terms that neither side holds, and those of both, which the common part puts right.
            as_group += (terms - held - held[at]) * _f(base[at], base)
            others = number != own
            one = np.full(int(others.sum()), own, np.int64)
            out += [(one, number[others], as_group[others]), (number[others], one, as_peer[others])]
        columns = [np.concatenate(c) for c in zip(*out)]
        lang = pa.array([mine.column("lang")[0].as_py()] * len(columns[0]), pa.string())
        return pa.table([lang, *map(pa.array, columns)], ["lang", "mine", "peer", "part"])

    piece = F.floor(F.col("mine") / ROWS)
    left = groups.select("lang", "mine").join(shares, ["lang", "mine"], "left")
    left = left.select("lang", piece.alias("piece"), "mine", F.coalesce("share", F.lit(1)).alias("share"), F.coalesce("times", F.lit(0)).alias("times"))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("peers") - 1) / ROWS))
    # Named anew, as both sides come from one table.
    named = [F.col(c).alias(c) for c in ("lang", "mine", "base", "held", "terms")]
    right = groups.select(F.explode(pieces).alias("piece"), *named)
    return left.groupBy("lang", "piece").cogroup(right.groupBy("lang", "piece")).applyInArrow(add, _PARTS)


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, best: int = BEST_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances from every peer, and the terms above the language's share."""
    counts = cut_lineage(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.withColumns({"in_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
    kept = cut_lineage(kept.filter(F.col("in_docs") >= least).select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    empty = F.lit("")
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    groups = every.join(totals, ["lang", "source"], "left").na.fill(0, ["total", "held"])
    langs = kept.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")
    )
    of_lang = Window.partitionBy("lang")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["terms", "lang_total"])
    groups = groups.withColumns(
        {
            "mine": (F.row_number().over(of_lang.orderBy("source")) - 1).cast("bigint"),
            "peers": F.count(F.lit(1)).over(of_lang),
            "postings": F.sum("held").over(of_lang),
            "base": _share(F.lit(0), F.col("total"), F.col("terms")),
        }
    )
    groups = cut_lineage(groups, "groups")

    facts = groups.select("lang", "source", "mine", "total", "terms", "lang_total", "base", "postings")
    known = kept.join(facts, ["lang", "source"]).withColumns(
        {
            "share": _share(F.col("n"), F.col("total"), F.col("terms")),
            "lang_share": _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
            "block": F.pmod(F.xxhash64("term"), F.ceil(F.col("postings") / POSTINGS)),
        }
    )
    postings = cut_lineage(known.select("lang", "source", "mine", "term", "share", "lang_share", "base", "block"), "postings")

    by_value = [F.desc("value"), F.asc("item")]
    shares = postings.groupBy("lang", "mine", "share").agg(F.count(F.lit(1)).alias("times"))
    parts = _common(postings).unionByName(_baselines(groups, shares))
    sums = parts.groupBy("lang", "mine", "peer").agg(F.sum(F.col("part").cast("decimal(20,0)")).cast("bigint").alias("value"))
    names = groups.select("lang", "mine", "source")
    pairs = sums.join(names, ["lang", "mine"]).join(names.select("lang", F.col("mine").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value)))

    gap = F.col("share") - F.col("lang_share")
    above = postings.filter(gap > 0).select(
        "lang", "source", F.col("term").alias("item"), F.call_function("div", gap * gap, F.col("lang_share")).alias("value")
    )
    terms = above.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value)))
    out = ("lang", "source", "part", "item", "value", "rank")
    return (
        pairs.withColumn("part", F.lit("pair")).select(*out)
        .unionByName(terms.filter(F.col("rank") <= best).withColumn("part", F.lit("term")).select(*out))
    )


def op11_divergence(spark, sf_dir):
    """Every source's divergence from each other source of its language, and its 200 terms above the language's share.

    Null texts, languages and sources are empty ones; a language without kept terms has zeros; an empty table gives no row.
    """
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total::HUGEINT + l.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + 1)) // (l.total::HUGEINT + l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked
WHERE part = 'pair' OR rank <= {BEST_TERMS}"""
