"""Mixing sources to target weights by Poisson replication.

Each source gets a rate: its target share of the whole, divided by its own size. A
document draws its number of copies by inverting the Poisson distribution of that
rate at a number hashed from the seed and its id, so a rerun draws the same.
Cases: null sources form one source; a null id draws as the text 'null'; rows that
repeat an id draw the same number; a source without weight, or with weight zero, is
left out; null or empty texts count zero characters; if a source has only such
texts its rate is zero; an empty table stays empty. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.session import cut_lineage

SEED = 20240601
# exp(-rate) must not underflow: larger rates are drawn in equal parts.
PART = 400.0
# Sources are flattened: target share in proportion to size to this power.
TEMPERATURE = 0.7
HEX_DIGITS = 13


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts, with 52 bits."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**HEX_DIGITS))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """``source, size``: characters per source."""
    size = F.coalesce(F.length(f"`{text}`").cast("bigint"), F.lit(0))
    return docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).alias("size"))


def tempered_weights(sizes: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """``source, weight``: target shares that flatten the natural ones."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(temperature)).alias("weight"))


def mixing_rates(sizes: DataFrame, weights: DataFrame, budget: float | None = None) -> DataFrame:
    """``source, rate, parts, cdf``: the mean copies of each source's documents and how to draw them.

    ``budget`` is the wanted size of the result in characters; by default that of the input.
    """
    both = sizes.join(weights.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    total = both.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = float(total["size"] or 0) if budget is None else float(budget)
    share = F.col("weight") / F.lit(float(total["weight"] or 1.0))
    rate = F.when(F.col("size") > 0, share * F.lit(budget) / F.col("size")).otherwise(F.lit(0.0))
    rated = both.filter(F.col("weight") > 0).select("source", rate.alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    split = rated.withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    # Far enough for the rest of the distribution to vanish beside 52 bits.
    reach = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 40).cast("int")
    none = F.exp(-F.col("mean"))
    start = F.struct(F.array(none).alias("cdf"), none.alias("p"), none.alias("sum"))

    def further(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mean") / k
        return F.struct(
            F.concat(acc["cdf"], F.array(acc["sum"] + p)).alias("cdf"), p.alias("p"), (acc["sum"] + p).alias("sum")
        )

    return split.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), reach), start, further)["cdf"]).drop("mean")


def mix_sources(
    docs: DataFrame,
    rates: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    seed: int = SEED,
    copy: str = "copy",
    order: str = "shuffle_key",
) -> DataFrame:
    """Each document as often as drawn, in a global random order.

    The rates have a row per source and a known size, so Spark chooses the join; a
    source with a third of the rows is split by adaptive execution if it is not
    broadcast. The order is that of a digest per copy: rows are dealt out by it and
    sorted by it within each task.
    """
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))
    drawn = rates.select(F.struct("source", "parts", "cdf").alias("__rate"))
    matched = docs.join(drawn, F.col(f"`{source}`").eqNullSafe(F.col("__rate.source")))

    def part(n: Column, j: Column) -> Column:
        # Bound to a variable, else the digest would be taken anew for every term.
        u = F.array(_unit(F.lit(str(seed)), name, j.cast("string")))
        return n + F.transform(u, lambda v: F.size(F.filter(F.col("__rate.cdf"), lambda c: c <= v)))[0]

    times = F.aggregate(F.sequence(F.lit(1), F.col("__rate.parts")), F.lit(0), part)
    counted = matched.withColumn("__times", times).drop("__rate").filter(F.col("__times") > 0)
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("__times")))).drop("__times")
    keyed = copies.withColumn(order, F.md5(F.concat_ws("|", F.lit(f"order{seed}"), name, F.col(copy).cast("string"))))
    return keyed.repartition(F.col(order)).sortWithinPartitions(order)


def tempered_mix(docs: DataFrame, temperature: float = TEMPERATURE, seed: int = SEED, **names: str) -> DataFrame:
    sizes = cut_lineage(source_sizes(docs), "source-sizes")
    rates = cut_lineage(mixing_rates(sizes, tempered_weights(sizes, temperature)), "mixing-rates")
    return mix_sources(docs, rates, seed=seed, **names)


def op1_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tempered_mix(docs)


def mixing_sql(table: str, columns: str) -> str:
    """DuckDB: the same draws; the table needs doc_id, source and text."""
    return f"""
WITH sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM {table} GROUP BY source
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN pow(size, {TEMPERATURE}) / (SELECT sum(pow(size, {TEMPERATURE})) FROM sizes)
    * (SELECT sum(size) FROM sizes) / size ELSE 0 END AS rate FROM sizes
), terms AS (
  SELECT source, k, CASE WHEN rate > 0 THEN exp(-rate + k * ln(rate) - lgamma(k + 1)) ELSE CAST(k = 0 AS INT) END AS p
  FROM rates, range(0, 200) AS r(k)
), cdf AS (
  SELECT source, list(s ORDER BY k) AS cdf
  FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS s FROM terms) GROUP BY source
), drawn AS (
  SELECT d.*, len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5(concat('{SEED}|', coalesce(CAST(doc_id AS VARCHAR), 'null'), '|1')), 1, {HEX_DIGITS}))::BIGINT / {float(16**HEX_DIGITS)})) AS times
  FROM {table} d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
), copies AS (
  SELECT *, CAST(unnest(range(1, times + 1)) AS INT) AS copy FROM drawn
)
SELECT {columns} FROM copies"""


OP1_SQL = mixing_sql(
    "documents",
    f"doc_id, text, lang, source, n_chars, copy, "
    f"md5(concat('order{SEED}|', coalesce(CAST(doc_id AS VARCHAR), 'null'), '|', copy)) AS shuffle_key",
)
