"""``spark-submit``-able command line: one sub-command per job."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tremorlake.operators.model import VARIATIONS, GbtParams, Variation
from tremorlake.plans import jobs
from tremorlake.schema import DECISION_THRESHOLD, TEST_SIZE
from tremorlake.sources.feeds import BULLETIN_SOURCES

METRICS = ("pr_auc", "f1_score", "recall")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tremorlake")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="landed feeds to a raw snapshot")
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--geojson")
    ingest.add_argument("--latest-bulletin", help="documents of the latest-events bulletin")
    ingest.add_argument("--felt-bulletin", help="documents of the felt-events bulletin")
    ingest.add_argument("--run", default=datetime.now(UTC).strftime("%Y%m%d_%H%M%S"))
    ingest.add_argument("--multi-line", action="store_true")
    ingest.add_argument("--dry-run", action="store_true")
    ingest.add_argument("--hours", type=int, help="how far back the main feed is asked for; all that has landed by default")

    preprocess = commands.add_parser("preprocess", help="raw snapshots to the clean table")
    preprocess.add_argument("--raw", required=True)
    preprocess.add_argument("--processed", required=True)
    preprocess.add_argument("--all", action="store_true")
    preprocess.add_argument("--input", help="name of the one snapshot to clean; the newest by default")

    features = commands.add_parser("features", help="clean table to feature table")
    features.add_argument("--processed", required=True)
    features.add_argument("--output", required=True)
    features.add_argument("--csv")

    refresh = commands.add_parser("refresh", help="new clean snapshots into the kept tables of events and features")
    refresh.add_argument("--processed", required=True)
    refresh.add_argument("--events", required=True)
    refresh.add_argument("--kept-features", required=True)

    train = commands.add_parser("train", help="train and compare the configurations")
    train.add_argument("--features", required=True)
    train.add_argument("--runs", required=True)
    train.add_argument("--models", required=True)
    train.add_argument("--run-name", help="train one configuration of this name instead of all that are known")
    train.add_argument("--trees", type=int, default=GbtParams.n_estimators)
    train.add_argument("--depth", type=int, default=GbtParams.max_depth)
    train.add_argument("--rate", type=float, default=GbtParams.learning_rate)
    train.add_argument("--threshold", type=float, default=DECISION_THRESHOLD)
    train.add_argument("--test-size", type=float, default=TEST_SIZE)
    train.add_argument("--no-resampling", action="store_true")

    evaluate = commands.add_parser("evaluate", help="exit 0 if the best run passes, else 1")
    evaluate.add_argument("--runs", required=True)
    evaluate.add_argument("--rule", choices=("all", "two-of-three"), default="all")
    for metric in METRICS:
        evaluate.add_argument(f"--min-{metric.replace('_', '-')}", type=float, help="instead of the rule's own bound")

    promote = commands.add_parser("promote", help="record a promotion")
    promote.add_argument("--history", required=True)
    promote.add_argument("--run-id", required=True)
    promote.add_argument("--model-name", required=True)
    promote.add_argument("--version", type=int, required=True)
    promote.add_argument("--stage", default="Staging", choices=("Staging", "Production"))
    promote.add_argument("--pr-auc", type=float, default=0.0)

    drift = commands.add_parser("drift", help="quick check, or the report per column")
    where = drift.add_mutually_exclusive_group(required=True)
    where.add_argument("--processed")
    where.add_argument("--events", help="the kept table of events; needs --counts, where counts per day are kept")
    drift.add_argument("--counts")
    drift.add_argument("--full-report", action="store_true")
    return parser


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"tremorlake-{args.command}").getOrCreate()
    if args.command == "ingest":
        paths = dict(zip(BULLETIN_SOURCES, (args.latest_bulletin, args.felt_bulletin)))
        shown = jobs.ingest_job(
            spark, args.raw, args.run, args.geojson,
            {source: path for source, path in paths.items() if path}, args.dry_run, args.multi_line, args.hours,
        )
        if shown is not None:
            shown.show(truncate=False)
    elif args.command == "preprocess":
        jobs.preprocess_job(spark, args.raw, args.processed, args.all, args.input)
    elif args.command == "features":
        jobs.features_job(spark, args.processed, args.output, args.csv)
    elif args.command == "refresh":
        jobs.refresh_job(spark, args.processed, args.events, args.kept_features)
    elif args.command == "train":
        variations = VARIATIONS
        if args.run_name:
            params = GbtParams(n_estimators=args.trees, max_depth=args.depth, learning_rate=args.rate)
            variations = (Variation(args.run_name, params, args.threshold),)
        runs = jobs.train_job(
            spark, args.features, args.runs, args.models, variations, not args.no_resampling, args.test_size
        )
        runs.drop("params").show(truncate=False)
    elif args.command == "evaluate":
        minimum = {m: v for m in METRICS if (v := getattr(args, f"min_{m}")) is not None}
        verdict = jobs.evaluate_job(spark, args.runs, args.rule, minimum)
        row = verdict.drop("params").first()
        print(row.asDict() if row else "no run found")
        return 0 if row and row["passed"] else 1
    elif args.command == "promote":
        entry = spark.range(1).select(
            F.lit(args.model_name).alias("model_name"),
            F.lit(args.version).cast("long").alias("version"),
            F.lit(args.stage).alias("stage"),
            F.current_timestamp().alias("promoted_at"),
            F.lit(args.run_id).alias("run_id"),
            F.lit(args.pr_auc).alias("pr_auc"),
        )
        jobs.promote_job(spark, entry, args.history).show(truncate=False)
    elif args.events:
        if not args.counts:
            raise SystemExit("--events needs --counts")
        jobs.kept_drift_job(spark, args.events, args.counts, args.full_report).show(truncate=False)
    else:
        jobs.drift_job(spark, args.processed, args.full_report).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
