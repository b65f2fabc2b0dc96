"""Quality rules: a threshold table compiled into one projection.

Every document is measured by built-in functions and judged by a table of bounds.
Cases: a null or blank text has no words and fails the least-words rule; repeated
rows and repeated ids are judged row by row; an empty table gives an empty table;
columns of the input stay as they are, and a column that is already called as the
result is replaced. Texts of any length are measured whole.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a all an and are as at be but by for from had have he his in is it not of on or one that the they "
    "this to was we were which with you your "
    "au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une "
    "als auf das dem den der die ein eine für im ist mit nicht sich und von zu "
    "al como con del el las lo los más no para por se sin su una y"
).split()


class Bound(NamedTuple):
    """``low <= 100 * measure / per <= high``, both ends optional; ``per`` None: the measure itself."""

    measure: str
    per: str | None
    low: int | None
    high: int | None


BASE_TABLE = (
    Bound("n_words", None, 20, None),
    Bound("n_repeat_words", "n_words", None, 30),
)
RULE_TABLE = (
    Bound("word_chars", "n_words", 250, 1200),
    Bound("n_symbols", "n_words", None, 10),
    Bound("n_stop_words", "n_words", 2, None),
    Bound("n_dup_lines", "n_lines", None, 50),
    Bound("n_bullet_lines", "n_lines", None, 90),
    Bound("n_ellipsis_lines", "n_lines", None, 30),
)


def compile_table(table: tuple[Bound, ...], measures: dict[str, Column]) -> Column:
    """One condition: every bound of the table holds. Whole numbers only, no division."""
    checks = []
    for bound in table:
        value, per = measures[bound.measure], F.lit(1)
        if bound.per is not None:
            value, per = value * 100, measures[bound.per]
        if bound.low is not None:
            checks.append(value >= per * bound.low)
        if bound.high is not None:
            checks.append(value <= per * bound.high)
    return reduce(and_, checks, F.lit(True))


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    result: str = "quality",
    base: tuple[Bound, ...] = BASE_TABLE,
    rules: tuple[Bound, ...] = RULE_TABLE,
) -> DataFrame:
    """The rows of ``docs`` with a struct column: all measures, ``base_failed`` and ``kept``.

    Repeated windows are found by a 64-bit digest per window, sorted with its place,
    so the work is n log n in the words of one text and nothing is shuffled.
    """
    words, ones, pairs, fours, placed, places = (
        f"__{result}_{x}" for x in ("words", "ones", "pairs", "fours", "placed", "places")
    )
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    joined = lambda runs, step: F.transform(runs, lambda h, i: F.xxhash64(h, F.get(runs, i + step)))
    # A window of eight that is found twice holds runs of four found twice; most texts have none.
    starts = F.slice(joined(fours, 4), F.lit(1), F.size(words) - (WINDOW - 1))
    with_places = F.when(
        (F.size(words) >= WINDOW) & (F.size(F.array_distinct(fours)) < F.size(fours)),
        F.sort_array(F.transform(starts, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.expr("array()").cast("array<struct<h:bigint,i:int>>"))
    same = lambda e, k: F.coalesce(F.get(placed, k)["h"] == e["h"], F.lit(False))
    repeated = F.filter(placed, lambda e, k: same(e, k - 1) | same(e, k + 1))
    staged = (
        docs.withColumn(words, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACES}]+")))
        .withColumn(ones, F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(pairs, joined(ones, 1))
        .withColumn(fours, joined(pairs, 2))
        .withColumn(placed, with_places)
        .withColumn(places, F.sort_array(F.transform(repeated, lambda e: e["i"])))
    )
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
    )["n"]
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    line_stats = F.transform(
        F.array(lines),
        lambda x: F.struct(
            _size(x).alias("n_lines"),
            (_size(x) - _size(F.array_distinct(x))).alias("n_dup_lines"),
            _size(F.filter(x, lambda line: F.ltrim(line).substr(1, 1).isin("-", "•", "‣", "▪"))).alias("n_bullet_lines"),
            _size(F.filter(x, lambda line: F.rtrim(line).endswith("…") | F.rtrim(line).endswith("..."))).alias(
                "n_ellipsis_lines"
            ),
        ),
    )[0]
    in_lines = f"__{result}_lines"
    measures = {
        "n_words": _size(F.col(words)),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": F.col(in_lines)["n_dup_lines"],
        "n_repeat_words": covered.cast("long"),
        "n_stop_words": _size(F.filter(words, lambda w: w.isin(STOP_WORDS))),
        "n_lines": F.col(in_lines)["n_lines"],
        "n_bullet_lines": F.col(in_lines)["n_bullet_lines"],
        "n_ellipsis_lines": F.col(in_lines)["n_ellipsis_lines"],
    }
    measured = f"__{result}_measures"
    staged = staged.withColumn(in_lines, line_stats).withColumn(
        measured, F.struct(*[m.alias(name) for name, m in measures.items()])
    )
    known = {name: F.col(measured)[name] for name in measures}
    failed = ~compile_table(base, known)
    verdict = F.struct(
        *[c.alias(name) for name, c in known.items()],
        failed.alias("base_failed"),
        (~failed & compile_table(rules, known)).alias("kept"),
    )
    return staged.withColumn(result, verdict).drop(words, ones, pairs, fours, placed, places, in_lines, measured)


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    judged = quality_rules(docs, text, "__quality")
    # A filter on a projection would be moved below it, with all measures spelled out anew; it stops at a generator.
    flagged = judged.withColumn("__kept", F.explode(F.array("__quality.kept"))).drop("__quality")
    return flagged.filter("__kept").drop("__kept")


CONTRACT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = quality_rules(docs)
    return judged.select("doc_id", *[F.col("quality")[name].alias(name) for name in CONTRACT])


def measures_sql(table: str) -> str:
    """DuckDB: the measures and the verdict of every row of a table of documents."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    word = r"[^\x20\x09-\x0D]+"
    names = {"per": "m."}

    def holds(rows: tuple[Bound, ...]) -> str:
        parts = []
        for b in rows:
            value = f"m.{b.measure}" if b.per is None else f"100 * m.{b.measure}"
            per = "" if b.per is None else f" * {names['per']}{b.per}"
            parts += [f"{value} >= {b.low}{per}"] * (b.low is not None)
            parts += [f"{value} <= {b.high}{per}"] * (b.high is not None)
        return " AND ".join(parts)

    blank = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH d AS (
  SELECT *, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{word}') AS ws FROM {table}
), l AS (
  SELECT *, list_filter(string_split(body, chr(10)), lambda x: trim(x, {blank}) <> '') AS ls FROM d
), win AS (
  SELECT doc_id, i, array_to_string(ws[i + 1:i + {WINDOW}], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - {WINDOW - 1})) AS i FROM d)
), rep AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM rep) GROUP BY doc_id
), m AS (
  SELECT l.*,
    CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(ws, lambda x: x IN ({stop}))) AS n_stop_words,
    len(ls) AS n_lines,
    len(list_filter(ls, lambda x: ltrim(x, ' ')[1] IN ('-', '•', '‣', '▪'))) AS n_bullet_lines,
    len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%…' OR rtrim(x, ' ') LIKE '%...')) AS n_ellipsis_lines
  FROM l LEFT JOIN cov USING (doc_id)
)
SELECT *, NOT ({holds(BASE_TABLE)}) AS base_failed, ({holds(BASE_TABLE)}) AND ({holds(RULE_TABLE)}) AS kept FROM m"""


OP8_SQL = f"SELECT doc_id, {', '.join(CONTRACT)} FROM ({measures_sql('documents')})"
