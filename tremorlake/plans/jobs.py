"""Jobs over folders: what a scheduler runs, one function per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tremorlake.operators import clean, gates, registry
from tremorlake.operators.dedup import first_per_key
from tremorlake.operators.drift import drift_quick_check, drift_report
from tremorlake.operators.merge import merge_days
from tremorlake.operators.model import VARIATIONS, Variation, save_model
from tremorlake.plans import drift_counts, refresh
from tremorlake.plans.catalogue import clean_events, ingest
from tremorlake.plans.features import build_feature_table
from tremorlake.plans.training import prepare_train_test, run_variations
from tremorlake.schema import CLEAN, RUNS, TEST_SIZE
from tremorlake.session import cut_lineage, ready
from tremorlake.sources import daily, feeds, sinks, snapshots, tables


def ingest_job(
    spark: SparkSession,
    raw_folder: str,
    run: str,
    geojson: str | None = None,
    bulletins: dict[str, str] | None = None,
    dry_run: bool = False,
    multi_line: bool = False,
    hours: int | None = None,
) -> DataFrame | None:
    """Landed feeds to one raw snapshot and its manifest row; a dry run returns the preview.

    ``bulletins`` maps a source name to the path of its documents. With ``hours`` the main feed is taken as its
    request asks for it: that far back from now, within the area, and of the feed's least magnitude.
    """
    parts = [feeds.scan_geojson_feed(spark, geojson, multi_line=multi_line)] if geojson else []
    if parts and hours is not None:
        now = F.current_timestamp()
        parts[0] = clean.feed_window(parts[0], now - F.make_dt_interval(hours=F.lit(hours)), now)
    for source, path in (bulletins or {}).items():
        parts.append(feeds.scan_bulletin_feed(spark, path, source, multi_line=multi_line).events)
    if not parts:
        raise ValueError("name at least one feed")
    rows = ingest(*parts)
    if dry_run:
        return sinks.sink_raw_snapshot(rows, raw_folder, run, dry_run=True)
    stored = cut_lineage(rows, "ingested")
    if not stored.isEmpty():
        sinks.sink_raw_snapshot(stored, raw_folder, run)
        named = stored.withColumn("snapshot", F.lit(f"gempa_{run}.csv"))
        sinks.sink_manifest(sinks.manifest_rows(named, F.current_timestamp()), f"{raw_folder}/manifest")
    return None


def preprocess_job(
    spark: SparkSession, raw_folder: str, processed: str, every: bool = False, name: str | None = None
) -> None:
    """Clean the newest raw snapshot, or the named one, or every one in a single job, each by itself.

    The table is partitioned by snapshot; a snapshot that is cleaned again replaces its own part only.
    """
    if every:
        raw = snapshots.scan_all_snapshots(spark, raw_folder)
    else:
        name = name or snapshots.list_snapshots(spark, raw_folder).agg(F.max("snapshot")).first()[0]
        raw = snapshots.scan_raw_csv(spark, f"{raw_folder}/{name}").withColumn("snapshot", F.lit(name))
    writer = clean_events(raw).hint("rebalance", "snapshot").write.partitionBy("snapshot")
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(processed)


def read_processed(spark: SparkSession, processed: str) -> DataFrame:
    """All cleaned snapshots, the first row per event in snapshot order."""
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in CLEAN)}, snapshot string"
    rows = ready(spark).read.schema(schema).parquet(processed)
    return first_per_key(rows, ["event_id"], [F.col("snapshot")]).select(*CLEAN.names)


def features_job(spark: SparkSession, processed: str, output: str, csv: str | None = None) -> None:
    sinks.sink_features(build_feature_table(cut_lineage(read_processed(spark, processed), "events")), output, csv)


# Events as ``refresh_job`` keeps them.
KEPT = StructType(CLEAN.fields + [StructField("snapshot", StringType())])


def _by_snapshot(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, ["event_id"], [F.col("snapshot")])


def refresh_job(spark: SparkSession, processed: str, events: str, features: str) -> None:
    """Bring the tables of events and features up to the newest cleaned snapshot.

    Both are tables by day that know the last snapshot they hold. Snapshots after it are read and merged, an event
    keeps its first row, and features are computed anew only where events were added. A run that stops after the
    events goes on with the features next time. A snapshot that is cleaned again after it was merged is not seen:
    give new folders then.
    """
    rows = ready(spark).read.schema(KEPT).parquet(processed)
    held = daily.last_mark(spark, events)
    newest = rows.agg(F.max("snapshot")).first()[0]
    if newest is not None and (held is None or newest > held):
        new = rows if held is None else rows.filter(F.col("snapshot") > held)
        merge_days(events, new, KEPT, _by_snapshot, newest)
        held = newest
    done = daily.last_mark(spark, features)
    if held is None or held == done:
        return
    catalogue = daily.read_days(spark, events, KEPT).drop("day")
    if done is None:
        refresh.rebuild_features(features, catalogue, held)
    else:
        refresh.refresh_features(features, catalogue, catalogue.filter(F.col("snapshot") > done), held)


def train_job(
    spark: SparkSession,
    features: str,
    runs: str,
    models: str,
    variations: tuple[Variation, ...] = VARIATIONS,
    balance: bool = True,
    test_size: float = TEST_SIZE,
) -> DataFrame:
    """Train the configurations, store one model per run, then append the runs; returns the runs.

    A model lies under its run's id, which no other run has. A run is logged when its model is there, so
    a job that stops in between leaves no run without a model.
    """
    train, test = prepare_train_test(tables.scan_features(spark, features), test_size)
    table, fitted = run_variations(train, test, variations, balance)
    logged = cut_lineage(table, "runs")
    ids = {r["run_name"]: r["run_id"] for r in logged.select("run_name", "run_id").collect()}
    for variation in variations:
        save_model(fitted[variation.params], f"{models}/{ids[variation.run_name]}", variation.threshold, spark)
    logged.write.mode("append").parquet(runs)
    return logged


def read_runs(spark: SparkSession, runs: str) -> DataFrame:
    return ready(spark).read.schema(RUNS).parquet(runs)


def evaluate_job(spark: SparkSession, runs: str, rule: str = "all", minimum: dict[str, float] | None = None) -> DataFrame:
    """The best run and its verdict: every metric (``all``) or the two-of-three rule.

    ``minimum`` replaces the rule's bounds of the metrics it names.
    """
    table, given = read_runs(spark, runs), minimum or {}
    if rule == "all":
        return gates.gate_all(gates.top_runs(table, limit=1), {**gates.CI_MINIMUM, **given})
    best = gates.top_runs(table, finished_only=False, limit=1)
    return gates.gate_two_of_three(best, {**gates.PROMOTION_MINIMUM, **given})


def promote_job(spark: SparkSession, entry: DataFrame, history: str) -> DataFrame:
    """Add a promotion entry to the history table; returns the newest entries."""
    entry.write.mode("append").parquet(history)
    return registry.history_keep_last(ready(spark).read.schema(entry.schema).parquet(history))


def drift_job(spark: SparkSession, processed: str, full: bool = False) -> DataFrame:
    events = read_processed(spark, processed)
    return drift_report(events) if full else drift_quick_check(events)


def kept_drift_job(spark: SparkSession, events: str, counts: str, full: bool = False) -> DataFrame:
    """The same over the kept table of events: only its days that changed since the last check are counted."""
    drift_counts.refresh_counts(ready(spark), events, KEPT, counts)
    rows = daily.read_days(spark, events, KEPT)
    check = drift_counts.drift_report if full else drift_counts.drift_quick_check
    return check(spark, counts, rows)
