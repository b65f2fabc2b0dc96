"""One registered query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.checks import inputs
from tremorlake.functions import catalogue, geo, text
from tremorlake.operators import (
    aftershocks,
    clean,
    dedup,
    drift,
    gates,
    isolation,
    metrics,
    model,
    registry,
    resample,
    split,
    summary,
)
from tremorlake.plans import catalogue as plans
from tremorlake.plans import features as feature_plan
from tremorlake.plans import drift_counts, refresh, training
from tremorlake.schema import FEATURE_TABLE, FEATURES, RAW_COLUMNS, TARGET
from tremorlake.session import cut_lineage, new_path, ready
from tremorlake.sources import feeds, sinks, snapshots, tables
from tremorlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(column: str | Column, digits: int = 6) -> Column:
    """Rounded, so engines that sum in another order still agree."""
    rounded = F.round(column, digits)
    return rounded.alias(column) if isinstance(column, str) else rounded


# -- sources and sinks ---------------------------------------------------------------

FIXED_TIME = "2024-02-01 00:00:00"


def _land_text(documents: DataFrame, name: str) -> str:
    path = new_path(documents.sparkSession, name)
    documents.write.text(path)
    return path


def _land_snapshots(spark: SparkSession, sf_dir: str, name: str = "landing") -> str:
    """Three overlapping raw snapshots in one folder, one run a day."""
    folder = new_path(spark, name)
    raw = inputs.raw_events(spark, sf_dir)
    n = F.col("feed_position")
    for k in range(3):
        rows = raw.filter((n % 3 == k) | (n % 10 == 0))
        stamped = rows.withColumn("ingested_at", F.lit(f"2024-02-0{k + 1}T00:00:00"))
        sinks.sink_raw_snapshot(stamped, folder, f"2024020{k + 1}_000000")
    return folder


def _raw_view(raw: DataFrame, *extra: str) -> DataFrame:
    """Raw text cells; numbers compared as numbers, as text forms of doubles vary."""
    numbers = ["latitude", "longitude", "depth_km", "magnitude"]
    kept = [c for c in RAW_COLUMNS if c not in numbers]
    return raw.select(*kept, *[_r(F.col(c).try_cast("double")).alias(c) for c in numbers], *extra)


@query
def scan_geojson_feed(spark, sf_dir):
    path = _land_text(inputs.geojson_documents(spark, sf_dir), "geojson")
    rows = feeds.scan_geojson_feed(spark, path, F.lit(FIXED_TIME).cast("timestamp"))
    return rows.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude", "magnitude")})


@query
def feed_pushdown_filter(spark, sf_dir):
    events = inputs.seismic_events(spark, sf_dir)
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-08 00:00:00", "2024-01-22 12:00:00"))
    rows = clean.feed_window(events, start, end)
    return rows.select("event_id", "time_utc", _r("latitude"), _r("longitude"), _r("magnitude"))


@query
def scan_bulletin_feed(spark, sf_dir):
    path = _land_text(inputs.bulletin_documents(spark, sf_dir), "bulletin")
    rows = feeds.scan_bulletin_feed(
        spark, path, feeds.BULLETIN_SOURCES[0], F.lit(FIXED_TIME).cast("timestamp")
    )
    return rows.events.drop("feed_position")


@query
def scan_bulletin_rejects(spark, sf_dir):
    path = _land_text(inputs.bulletin_documents(spark, sf_dir), "bulletin")
    rejects = feeds.scan_bulletin_feed(spark, path, feeds.BULLETIN_SOURCES[0]).rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_raw_csv(spark, sf_dir):
    folder = new_path(spark, "raw")
    sinks.sink_raw_snapshot(inputs.raw_events(spark, sf_dir), folder, "20240201_000000")
    return _raw_view(snapshots.scan_raw_csv(spark, f"{folder}/gempa_20240201_000000.csv"))


@query
def scan_latest_snapshot(spark, sf_dir):
    return _raw_view(snapshots.scan_latest_snapshot(spark, _land_snapshots(spark, sf_dir)))


@query
def scan_all_snapshots(spark, sf_dir):
    return _raw_view(snapshots.scan_all_snapshots(spark, _land_snapshots(spark, sf_dir)), "snapshot")


def _clean_view(rows: DataFrame) -> DataFrame:
    shown = rows.drop("feed_position")
    return shown.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude", "magnitude")})


@query
def scan_processed_union(spark, sf_dir):
    raw = snapshots.scan_all_snapshots(spark, _land_snapshots(spark, sf_dir))
    folder = new_path(spark, "processed")
    for k in range(3):
        one = raw.filter(F.col("snapshot") == f"gempa_2024020{k + 1}_000000.csv").drop("snapshot")
        sinks.sink_processed(
            plans.clean_events(one), new_path(spark, "clean"), folder, f"2024020{k + 1}_000000"
        )
    return _clean_view(snapshots.scan_processed_union(spark, folder))


def _stored_events(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "events")
    sinks.sink_processed(plans.clean_events(inputs.raw_events(spark, sf_dir)).drop("feed_position"), path)
    return path


@query
def scan_events_db(spark, sf_dir):
    stored = _stored_events(spark, sf_dir)
    return tables.scan_events_table(spark, stored, ["magnitude", "time_utc"]).select(
        _r("magnitude"), "time_utc"
    )


@query
def sink_raw_snapshot(spark, sf_dir):
    folder = new_path(spark, "raw")
    raw = inputs.raw_events(spark, sf_dir)
    sinks.sink_raw_snapshot(raw, folder, "20240201_000000")
    return _raw_view(snapshots.scan_latest_snapshot(spark, folder))


@query
def sink_manifest(spark, sf_dir):
    landed = snapshots.scan_all_snapshots(spark, _land_snapshots(spark, sf_dir))
    path = new_path(spark, "manifest")
    sinks.sink_manifest(sinks.manifest_rows(landed, F.lit(FIXED_TIME).cast("timestamp")), path)
    return spark.read.parquet(path)


@query
def sink_processed(spark, sf_dir):
    return _clean_view(tables.scan_events_table(ready(spark), _stored_events(spark, sf_dir)))


# -- cleaning ------------------------------------------------------------------------


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.typed_events(inputs.raw_events(spark, sf_dir))


@query
def conform_schema(spark, sf_dir):
    partial = inputs.raw_events(spark, sf_dir).drop("depth_km", "magnitude_type", "place")
    rows = clean.conform_schema(partial)
    return rows.select("event_id", "source", "time_utc", "depth_km", "magnitude_type", "place", "status")


@query
def normalize_types(spark, sf_dir):
    return _clean_view(_typed(spark, sf_dir))


@query
def drop_critical_nulls(spark, sf_dir):
    return _clean_view(clean.drop_critical_nulls(_typed(spark, sf_dir)))


@query
def impute_defaults(spark, sf_dir):
    return _clean_view(clean.impute_defaults(_typed(spark, sf_dir)))


@query
def filter_bbox(spark, sf_dir):
    return _clean_view(clean.filter_bbox(_typed(spark, sf_dir)))


@query
def filter_valid_ranges(spark, sf_dir):
    return _clean_view(clean.filter_valid_ranges(clean.impute_defaults(_typed(spark, sf_dir))))


@query
def clean_events(spark, sf_dir):
    return _clean_view(plans.clean_events(inputs.raw_events(spark, sf_dir)))


@query
def quality_report(spark, sf_dir):
    return plans.quality_report(inputs.raw_events(spark, sf_dir)).withColumn("value", F.round("value", 6))


# -- scalar functions ----------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed-style texts made from the events."""
    n = F.col("event_id")
    hundredths = (F.col("user_id") * 37 % 18000 / 100).cast("decimal(6,2)").cast("string")
    suffix = F.get(
        F.array(*[F.lit(s) for s in (" LS", " LU", " BT", " bb", " S", " w", "", " N")]), (n % 8).cast("int")
    )
    coord = F.when(n % 31 == 0, F.lit("  ")).when(n % 37 == 0, F.lit("x LS")).otherwise(
        F.concat(hundredths, suffix)
    )
    return inputs.events_table(spark, sf_dir).select(
        "event_id",
        "ts",
        coord.alias("coord"),
        F.when(n % 29 == 0, F.lit("? km")).otherwise(F.concat(n % 701, F.lit(" km"))).alias("depth"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        (F.col("user_id") % 60 / 10).cast("decimal(3,1)").cast("string").alias("size"),
        F.when(n % 3 != 0, F.concat(F.lit("Site "), n % 100)).alias("region"),
        F.when(n % 2 != 0, F.col("event_type")).alias("remark"),
    )


@query
def parse_hemisphere_coord(spark, sf_dir):
    return _texts(spark, sf_dir).select("event_id", "coord", text.hemisphere_coord(F.col("coord")).alias("degrees"))


@query
def parse_depth_km(spark, sf_dir):
    return _texts(spark, sf_dir).select("event_id", text.depth_km(F.col("depth")).alias("depth_km"))


@query
def compose_event_id(spark, sf_dir):
    made = text.bulletin_event_id(F.col("date_time"), F.col("size"))
    return _texts(spark, sf_dir).select("event_id", made.alias("bulletin_id"))


@query
def coalesce_place(spark, sf_dir):
    made = text.coalesce_place(F.col("region"), F.col("remark"))
    return _texts(spark, sf_dir).select("event_id", made.alias("place"))


@query
def epoch_ms_to_utc(spark, sf_dir):
    made = text.epoch_ms_to_utc(F.unix_millis("ts"))
    return inputs.events_table(spark, sf_dir).select("event_id", made.alias("time_utc"))


def _per_event(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    events = inputs.seismic_events(spark, sf_dir)
    return events.select("event_id", *[column.alias(name) for name, column in columns.items()])


@query
def date_parts(spark, sf_dir):
    return _per_event(spark, sf_dir, **catalogue.date_parts(F.col("time_utc")))


@query
def depth_category(spark, sf_dir):
    return _per_event(spark, sf_dir, depth_category=catalogue.depth_category(F.col("depth_km")))


@query
def magnitude_category(spark, sf_dir):
    shifted = F.round(F.col("magnitude") - 2.5, 1)
    return _per_event(
        spark,
        sf_dir,
        magnitude_category=catalogue.magnitude_category(F.col("magnitude")),
        shifted_category=catalogue.magnitude_category(shifted),
    )


@query
def fault_zone_name(spark, sf_dir):
    return _per_event(spark, sf_dir, zona_sesar=geo.fault_zone_name(F.col("latitude"), F.col("longitude")))


@query
def fault_zone_code(spark, sf_dir):
    return _per_event(spark, sf_dir, zona_sesar=geo.fault_zone_code(F.col("latitude"), F.col("longitude")))


@query
def is_felt(spark, sf_dir):
    felt = F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 5 - 1).cast("double"))
    return _per_event(spark, sf_dir, is_felt=catalogue.is_felt(felt))


@query
def haversine_km(spark, sf_dir):
    jakarta = (F.lit(-6.2088), F.lit(106.8456))
    distance = geo.haversine_km(*jakarta, F.col("latitude"), F.col("longitude"))
    return _per_event(spark, sf_dir, distance_km=_r(distance))


@query
def omori_rate(spark, sf_dir):
    return _per_event(spark, sf_dir, rate=_r(catalogue.omori_rate(F.col("event_id") % 200)))


@query
def threshold_predict(spark, sf_dir):
    predicted = catalogue.threshold_predict(F.col("proba"), 0.45)
    return inputs.scored_events(spark, sf_dir).select("id", "proba", predicted.alias("prediction"))


@query
def risk_label(spark, sf_dir):
    scored = inputs.scored_events(spark, sf_dir)
    predicted = catalogue.threshold_predict(F.col("proba"), 0.45)
    return scored.select(
        "id",
        catalogue.class_label(F.col("y")).alias("actual_label"),
        catalogue.class_label(predicted).alias("predicted_label"),
        catalogue.risk_label(predicted).alias("risk"),
        (F.col("y") == predicted).alias("matches"),
    )


# -- joins, features -----------------------------------------------------------------


@query
def mainshock_isolation(spark, sf_dir):
    found = isolation.find_mainshocks(inputs.seismic_events(spark, sf_dir))
    return found.select("event_id", "time_utc", _r("latitude"), _r("longitude"), _r("magnitude"))


@query
def aftershock_pairs(spark, sf_dir):
    events = inputs.seismic_events(spark, sf_dir)
    pairs = aftershocks.aftershock_pairs(cut_lineage(isolation.find_mainshocks(events), "mainshocks"), events)
    return pairs.withColumns(
        {c: F.round(c, 6) for c in ("aftershock_magnitude", "distance_km")}
    )


@query
def snapshot_expand(spark, sf_dir):
    found = isolation.find_mainshocks(inputs.seismic_events(spark, sf_dir))
    return aftershocks.snapshot_expand(found.select("event_id", "time_utc"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_plan.build_feature_table(inputs.seismic_events(spark, sf_dir))


def _rounded_features(table: DataFrame) -> DataFrame:
    doubles = [c for c, kind in table.dtypes if kind == "double"]
    return table.withColumns({c: F.round(c, 6) for c in doubles})


@query
def build_feature_table(spark, sf_dir):
    return _rounded_features(_features(spark, sf_dir))


@query
def refresh_features(spark, sf_dir):
    """Three snapshots that arrive one after the other, each with days of its own and late events."""
    events = inputs.seismic_events(spark, sf_dir)
    late = F.col("event_id") % 500 == 0
    second, third = (F.col("time_utc") >= F.lit(t).cast("timestamp") for t in ("2024-01-22", "2024-01-28"))
    arrival = F.when(third, 2).when(second, F.when(late, 2).otherwise(1)).otherwise(F.when(late, 1).otherwise(0))
    arrived = cut_lineage(events.withColumn("arrival", arrival), "arrivals")
    table = new_path(spark, "kept-features")
    refresh.rebuild_features(table, arrived.filter("arrival = 0").drop("arrival"))
    for n in (1, 2):
        seen = arrived.filter(F.col("arrival") <= n)
        refresh.refresh_features(table, seen.drop("arrival"), seen.filter(F.col("arrival") == n).drop("arrival"), str(n))
    return _rounded_features(refresh.read_kept_features(spark, table))


@query
def aftershock_features(spark, sf_dir):
    counts = [c for c in FEATURES if "susulan" in c]
    return _rounded_features(_features(spark, sf_dir)).select("mainshock_id", "snapshot_hours", *counts)


@query
def aftershock_label(spark, sf_dir):
    return _features(spark, sf_dir).select("mainshock_id", "snapshot_hours", TARGET)


@query
def select_features(spark, sf_dir):
    return _rounded_features(clean.select_features(_features(spark, sf_dir), FEATURES, TARGET))


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "features")
    sinks.sink_features(_features(spark, sf_dir), path)
    return tables.scan_features(spark, path)


@query
def scan_features(spark, sf_dir):
    return _rounded_features(_stored_features(spark, sf_dir))


@query
def sink_features(spark, sf_dir):
    folder = new_path(spark, "features-csv")
    sinks.sink_features(_features(spark, sf_dir), new_path(spark, "features"), folder)
    return _rounded_features(spark.read.schema(FEATURE_TABLE).options(header=True, enforceSchema=False).csv(folder))


# -- aggregates and metrics ----------------------------------------------------------


@query
def label_distribution(spark, sf_dir):
    counts = summary.label_distribution(_features(spark, sf_dir))
    return counts.select("label", "n", _r("share"))


@query
def magnitude_describe(spark, sf_dir):
    described = summary.magnitude_describe(inputs.seismic_events(spark, sf_dir))
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


@query
def group_counts(spark, sf_dir):
    events = clean.add_derived(inputs.seismic_events(spark, sf_dir))
    return summary.group_counts(events, "zona_sesar", "source")


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(inputs.scored_events(spark, sf_dir))


@query
def classification_metrics(spark, sf_dir):
    scored = metrics.classification_metrics(inputs.scored_events(spark, sf_dir))
    return scored.select(_r("f1_score"), _r("recall"))


@query
def average_precision(spark, sf_dir):
    return metrics.average_precision(inputs.scored_events(spark, sf_dir)).select(_r("average_precision"))


@query
def average_precision_by_source(spark, sf_dir):
    by_source = metrics.average_precision(inputs.scored_events(spark, sf_dir), ["source"])
    return by_source.select("source", _r("average_precision"))


@query
def classification_report(spark, sf_dir):
    report = metrics.classification_report(inputs.scored_events(spark, sf_dir))
    return report.select("row", _r("precision"), _r("recall"), _r("f1_score"), "support")


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(inputs.scored_events(spark, sf_dir)).select(_r("roc_auc"))


@query
def three_metrics(spark, sf_dir):
    scored = metrics.three_metrics(inputs.scored_events(spark, sf_dir))
    return scored.select(_r("pr_auc"), _r("f1_score"), _r("recall"))


@query
def class_weight(spark, sf_dir):
    weight = metrics.class_weight(inputs.scored_events(spark, sf_dir))
    return weight.select("positives", "negatives", _r("scale_pos_weight"))


@query
def threshold_tradeoff(spark, sf_dir):
    table = metrics.threshold_tradeoff(inputs.scored_events(spark, sf_dir), [0.45, 0.40])
    rates = ("accuracy", "precision", "recall", "f1_score")
    return table.withColumns({c: F.round(c, 6) for c in rates})


@query
def psi(spark, sf_dir):
    time = F.col("time_utc")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    scores = drift.psi(inputs.seismic_events(spark, sf_dir), "magnitude", time < cut, time >= cut)
    return scores.select("feature", _r("psi"), "band")


@query
def drift_quick_check(spark, sf_dir):
    check = drift.drift_quick_check(inputs.seismic_events(spark, sf_dir))
    return check.withColumn("psi_magnitude", F.round("psi_magnitude", 6))


def _rounded_report(report: DataFrame) -> DataFrame:
    return report.drop("status").withColumns({c: F.round(c, 6) for c in ("ks", "wasserstein_normed", "psi", "drift_share")})


@query
def drift_report(spark, sf_dir):
    return _rounded_report(drift.drift_report(inputs.seismic_events(spark, sf_dir)))


def _kept_counts(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Counts of the first weeks, then of the days that new and late events touch."""
    events, table = inputs.seismic_events(spark, sf_dir), new_path(spark, "kept-counts")
    later = (F.col("time_utc") >= F.lit("2024-01-24").cast("timestamp")) | (F.col("event_id") % 500 == 0)
    days = lambda rows: rows.select(F.to_date("time_utc").alias("day")).distinct()
    drift_counts.count_days(table, events.filter(~later), days(events.filter(~later)))
    drift_counts.count_days(table, events, days(events.filter(later)))
    return table, events


@query
def drift_quick_check_kept(spark, sf_dir):
    check = drift_counts.drift_quick_check(spark, *_kept_counts(spark, sf_dir))
    return check.withColumn("psi_magnitude", F.round("psi_magnitude", 6))


@query
def drift_report_kept(spark, sf_dir):
    return _rounded_report(drift_counts.drift_report(spark, *_kept_counts(spark, sf_dir)))


# -- ranking, dedup, splits ----------------------------------------------------------


@query
def dedup_source_priority(spark, sf_dir):
    return _clean_view(dedup.dedup_source_priority(plans.screened_events(inputs.raw_events(spark, sf_dir))))


@query
def dedup_feed_order(spark, sf_dir):
    rows = dedup.dedup_feed_order(inputs.raw_events(spark, sf_dir))
    return rows.select("event_id", "source", "time_utc", "feed_position")


@query
def union_feeds(spark, sf_dir):
    events = inputs.seismic_events(spark, sf_dir)
    main = events.filter(F.col("source") == "USGS").select("event_id", "source", "magnitude", "depth_km")
    bulletin = events.filter(F.col("source") != "USGS").select("magnitude", "source", "event_id")
    return dedup.union_feeds(main, bulletin).withColumn("magnitude", F.round("magnitude", 6))


@query
def time_split(spark, sf_dir):
    rows = split.time_split(_stored_features(spark, sf_dir))
    return rows.select("mainshock_id", "mainshock_time", "snapshot_hours", "part")


@query
def stratified_split(spark, sf_dir):
    rows = split.stratified_split(_stored_features(spark, sf_dir), ["mainshock_id", "snapshot_hours"])
    return rows.select("mainshock_id", "snapshot_hours", TARGET, "part")


@query
def history_keep_last(spark, sf_dir):
    entries = inputs.promotions(spark, sf_dir)
    half = F.col("version") % 2 == 0
    return registry.history_keep_last(entries.filter(half), entries.filter(~half))


@query
def current_stage(spark, sf_dir):
    return registry.current_stage(inputs.stage_transitions(spark, sf_dir))


@query
def sort_by_time(spark, sf_dir):
    events = inputs.seismic_events(spark, sf_dir)
    return events.select("event_id", "time_utc").orderBy("time_utc", "event_id")


@query
def top_runs(spark, sf_dir):
    runs = gates.top_runs(inputs.model_runs(spark, sf_dir))
    return runs.select("run_id", "run_name", _r("pr_auc"), _r("f1_score"), _r("recall"))


@query
def best_run(spark, sf_dir):
    run = gates.best_run(inputs.model_runs(spark, sf_dir))
    return run.select("run_id", _r("pr_auc"), _r("f1_score"), _r("recall"))


@query
def preview(spark, sf_dir):
    rows = sinks.preview(inputs.seismic_events(spark, sf_dir), ["time_utc", "event_id"])
    return rows.select("event_id", "time_utc", _r("magnitude"))


# -- gates, registry, streaming ------------------------------------------------------


@query
def gate_all(spark, sf_dir):
    judged = gates.gate_all(inputs.model_runs(spark, sf_dir))
    return judged.select("run_id", "pass_pr_auc", "pass_f1_score", "pass_recall", "passed")


@query
def gate_details(spark, sf_dir):
    details = gates.gate_details(inputs.model_runs(spark, sf_dir))
    return details.select("run_id", "metric", _r("actual"), "threshold", "passed")


@query
def gate_two_of_three(spark, sf_dir):
    judged = gates.gate_two_of_three(inputs.model_runs(spark, sf_dir))
    return judged.select("run_id", "n_passed", "passed")


@query
def promote_champion(spark, sf_dir):
    promoted = registry.promote_first_two(inputs.model_versions(spark, sf_dir))
    described = registry.describe_production(promoted, inputs.model_runs(spark, sf_dir))
    champions = promoted.select("model_name", "version", "alias")
    return described.join(champions, ["model_name", "version"])


@query
def alias_lookup(spark, sf_dir):
    versions = inputs.model_versions(spark, sf_dir)
    promoted = registry.promote_first_two(versions)
    staged = versions.join(promoted.select("run_id", "stage"), "run_id", "left").withColumn(
        "stage", F.coalesce("stage", F.lit(registry.UNSTAGED))
    )
    aliases = promoted.select("model_name", "version", "alias")
    shown = registry.registry_summary(staged, inputs.model_runs(spark, sf_dir), aliases)
    return shown.withColumns({c: F.round(c, 6) for c in registry.METRICS})


@query
def stream_ingest_dedup(spark, sf_dir):
    landing = _land_snapshots(spark, sf_dir, "stream-landing")
    table, state = new_path(spark, "stream-table"), new_path(spark, "stream-state")
    ingest.append_screened(ingest.read_landing(spark, f"{landing}/*"), table, state).awaitTermination()
    return _clean_view(ingest.read_screened(spark, table))


@query
def stream_merge_by_day(spark, sf_dir):
    """Snapshots land one by one; each is streamed and merged before the next."""
    landed = _land_snapshots(spark, sf_dir, "merge-landing")
    table, state, merged = (new_path(spark, f"merge-{n}") for n in ("table", "state", "events"))
    landing = new_path(spark, "merge-stream")
    for k in (1, 2, 3):
        one = snapshots.scan_raw_csv(spark, f"{landed}/gempa_2024020{k}_000000.csv")
        sinks.sink_raw_snapshot(one, landing, f"2024020{k}_000000")
        ingest.append_screened(ingest.read_landing(spark, f"{landing}/*"), table, state).awaitTermination()
        ingest.merge_screened(spark, table, merged)
    return _clean_view(ingest.read_merged(spark, merged))


# -- class balancing and models ------------------------------------------------------


def _keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(resample.keyed(_features(spark, sf_dir), training.KEYS), "keyed")


@query
def tomek_links(spark, sf_dir):
    return resample.tomek_links(_keyed_features(spark, sf_dir))


@query
def smote_oversample(spark, sf_dir):
    rows = resample.smote_oversample(_keyed_features(spark, sf_dir), one_class=True)
    return rows.select("id", "y", "synthetic", *[_r(F.get("v", F.lit(i))).alias(f) for i, f in enumerate(FEATURES)])


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return training.prepare_train_test(_stored_features(spark, sf_dir))


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[model.BoostedTrees, float, DataFrame]:
    """A model fitted on this data, stored and read back with its threshold, and the test rows."""
    train, test = _split(spark, sf_dir)
    path = new_path(spark, "model")
    fitted = model.train_gbt(training.resampled_train(train), model.LIGHT)
    model.save_model(fitted, path, model.DECISION_THRESHOLD, spark)
    return (*model.load_model(path, spark), test)


@query
def train_gbt(spark, sf_dir):
    fitted, threshold, test = _fitted(spark, sf_dir)
    return metrics.three_metrics(model.batch_score(fitted, test, threshold), threshold)


@query
def train_variations(spark, sf_dir):
    runs, _ = training.run_variations(*_split(spark, sf_dir))
    return runs.drop("params")


@query
def batch_score(spark, sf_dir):
    fitted, threshold, test = _fitted(spark, sf_dir)
    scored = model.batch_score(fitted, test, threshold)
    return scored.select("mainshock_id", "snapshot_hours", "y", _r("proba"), "prediction")


@query
def feature_importance(spark, sf_dir):
    fitted, _, _ = _fitted(spark, sf_dir)
    return model.feature_importance(fitted, spark)
