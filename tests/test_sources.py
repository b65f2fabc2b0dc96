import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tremorlake.operators.dedup import dedup_source_priority
from tremorlake.operators.merge import merge_days
from tremorlake.plans.catalogue import clean_events
from tremorlake.schema import CLEAN, RAW_COLUMNS, RAW_TEXT, RAW_TYPED
from tremorlake.sources import daily, feeds, sinks, snapshots, tables
from tremorlake.streaming import ingest

ROW = ("a", "USGS", "2026-05-12T08:53:56+00:00", "4.8", "127.5", "108.5", "5.0", "mb", "sea, north", None, "reviewed", "2026-05-12T11:00:00+00:00")


def raw(spark, *ids, **changes):
    rows = [tuple(changes.get(c, i if c == "event_id" else v) for c, v in zip(RAW_COLUMNS, ROW)) for i in ids]
    return spark.createDataFrame(rows, RAW_TEXT)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_main_feed(spark, tmp_path):
    features = [
        {"id": "us1", "properties": {"time": 1700000000999, "mag": 5.1, "magType": "mb", "place": "x", "mmi": None, "status": "ok"},
         "geometry": {"coordinates": [100.5, -2.5, 33.0]}},
        {"id": "us2", "properties": {"time": 1700000001000, "mag": None}, "geometry": {"coordinates": [101.0, -3.0]}},
    ]
    write(tmp_path / "feed.json", json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    rows = feeds.scan_geojson_feed(spark, str(tmp_path), multi_line=True).orderBy("event_id").collect()
    assert [(r.event_id, r.latitude, r.longitude, r.depth_km, r.magnitude, r.source) for r in rows] == [
        ("us1", -2.5, 100.5, 33.0, 5.1, "USGS"), ("us2", -3.0, 101.0, None, None, "USGS"),
    ]
    assert rows[0].time_utc.microsecond == 0


ITEM = {"DateTime": "2026-04-17T22:19:22+00:00", "Magnitude": "5.1", "Lintang": "6.10 LS", "Bujur": "131.32 BT",
        "Kedalaman": "99 km", "Wilayah": "far", "Dirasakan": "II"}


def bulletin(spark, path, gempa):
    write(path / "b.json", json.dumps({"Infogempa": {"gempa": gempa}}, indent=1))
    return feeds.scan_bulletin_feed(spark, str(path), "BMKG-terkini", multi_line=True)


def test_bulletin_list_and_lone_object(spark, tmp_path):
    lone = bulletin(spark, tmp_path / "lone", ITEM).events.collect()
    listed = bulletin(spark, tmp_path / "list", [ITEM, {**ITEM, "Magnitude": "4.0"}]).events.collect()
    assert len(lone) == 1 and len(listed) == 2
    row = lone[0]
    assert (row.event_id, row.latitude, row.longitude, row.depth_km) == (
        "BMKG-2026-04-17T22:19:22+00:00-5.1", -6.1, 131.32, 99.0,
    )
    assert (row.magnitude_type, row.status, row.place, row.felt_intensity) == ("M", "reviewed", "far", "II")


def test_bulletin_rejects_rows_one_by_one(spark, tmp_path):
    without = [{k: v for k, v in ITEM.items() if k != gone} for gone in ("DateTime", "Magnitude", "Lintang", "Kedalaman", "Wilayah")]
    bad = [{**ITEM, "Magnitude": "?"}, {**ITEM, "Lintang": "x LS"}, {**ITEM, "Kedalaman": None}, {**ITEM, "Lintang": None}]
    out = bulletin(spark, tmp_path, [*without, *bad, ITEM])
    rows = out.events.orderBy("feed_position").collect()
    assert [r.feed_position for r in rows] == [2, 3, 4, 9]
    assert (rows[0].latitude, rows[1].depth_km, rows[2].place) == (0.0, 0.0, "")
    reasons = sorted(r.reason for r in out.rejects.collect())
    assert reasons == ["depth_km", "event_id", "event_id,magnitude", "latitude", "latitude", "magnitude"]


def test_broken_bulletin_items_and_documents_are_rejected(spark, tmp_path):
    out = bulletin(spark, tmp_path / "items", [ITEM, 5, "text", None, ["list"], {**ITEM, "Magnitude": "4.0", "Extra": {"a": [1]}}])
    assert sorted(r.feed_position for r in out.events.collect()) == [0, 5]
    assert sorted((r.item or "", r.reason) for r in out.rejects.collect()) == sorted([("", "item"), ('["list"]', "item"), ("5", "item"), ("text", "item")])
    lines = [json.dumps({"Infogempa": {"gempa": [ITEM]}}), '{"Infogempa": {"gempa": [{"Date', json.dumps({"Infogempa": {}}), json.dumps({"Infogempa": {"gempa": "?"}})]
    write(tmp_path / "documents" / "b.json", "\n".join(lines))
    out = feeds.scan_bulletin_feed(spark, str(tmp_path / "documents"), "BMKG-terkini")
    assert out.events.count() == 1
    assert sorted((r.item or "", r.reason) for r in out.rejects.collect()) == [("", "document"), ("?", "document"), (lines[1], "document")]


def test_broken_features_and_documents_are_rejected(spark, tmp_path):
    sound = {"id": "a", "properties": {"time": 1000, "mag": 5.0}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}}
    partly = {"id": "b", "properties": {"time": "soon", "mag": 4.0}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}}
    lines = [json.dumps({"features": [sound, 7, "x", None, partly]}), '{"features": [', json.dumps({"features": 3}), json.dumps({"features": []})]
    write(tmp_path / "f.json", "\n".join(lines))
    rows = feeds.scan_geojson_feed(spark, str(tmp_path)).orderBy("feed_position").collect()
    assert [(r.event_id, r.feed_position, r.latitude) for r in rows] == [("a", 0, 2.0), ("b", 4, 2.0)]
    rejects = sorted((r.item or "", r.reason) for r in feeds.geojson_rejects(spark, str(tmp_path)).collect())
    assert rejects == sorted([("", "item"), ("7", "item"), ("x", "item"), (lines[1], "document"), (lines[2], "document")])


def test_raw_csv_missing_empty_and_markers(spark, tmp_path):
    assert snapshots.scan_raw_csv(spark, str(tmp_path / "none.csv")).count() == 0
    write(tmp_path / "gempa_1.csv", "")
    assert snapshots.scan_raw_csv(spark, str(tmp_path / "gempa_1.csv")).count() == 0
    write(tmp_path / "gempa_2.csv", ",".join(RAW_COLUMNS) + '\na,USGS,2026,1,2,NA,5,N/A,"sea, ""north""",,null,\n')
    row = snapshots.scan_raw_csv(spark, str(tmp_path / "gempa_2.csv")).first()
    assert (row.depth_km, row.magnitude_type, row.place, row.felt_intensity, row.status) == (None, None, 'sea, "north"', None, None)


def test_snapshot_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    sinks.sink_raw_snapshot(raw(spark, "a", "b"), folder, "20260101_000000")
    sinks.sink_raw_snapshot(raw(spark, "b", "c", "d"), folder, "20260102_000000")
    with pytest.raises(AnalysisException):
        sinks.sink_raw_snapshot(raw(spark, "x"), folder, "20260102_000000")
    assert sorted(r.event_id for r in snapshots.scan_latest_snapshot(spark, folder).collect()) == ["b", "c", "d"]
    everything = snapshots.scan_all_snapshots(spark, folder)
    assert everything.count() == 5
    manifest = sinks.manifest_rows(everything, F.lit("now"))
    sinks.sink_manifest(manifest, f"{folder}/manifest")
    sinks.sink_manifest(manifest, f"{folder}/manifest")
    rows = spark.read.parquet(f"{folder}/manifest").collect()
    assert sorted((r.output_file, r.row_count, r.status) for r in rows) == 2 * [
        ("gempa_20260101_000000.csv", 2, "success")] + 2 * [("gempa_20260102_000000.csv", 3, "success")]


def test_no_snapshots(spark, tmp_path):
    assert snapshots.scan_latest_snapshot(spark, str(tmp_path)).count() == 0


def test_dry_run_writes_nothing(spark, tmp_path):
    shown = sinks.sink_raw_snapshot(raw(spark, *"abcdefg"), str(tmp_path / "out"), "x", dry_run=True)
    assert shown.count() == 5 and not (tmp_path / "out").exists()


def test_processed_union_keeps_the_first_file(spark, tmp_path):
    head = ",".join(CLEAN.names)
    line = "{id},USGS,{time},1.0,100.0,10.0,5.0,mb,{place},0.0,reviewed,2026-05-12 11:05:27+00:00,2026,5,8,shallow,moderate,x,False"
    good = "2026-05-12 08:53:56+00:00"
    write(tmp_path / "gempa_1_processed.csv", "\n".join([head, line.format(id="a", time="bad", place="first"), line.format(id="b", time=good, place="first")]))
    write(tmp_path / "gempa_2_processed.csv", "\n".join([head, line.format(id="a", time=good, place="second"), line.format(id="b", time=good, place="second"), line.format(id="c", time=good, place="second")]))
    rows = {r.event_id: (r.place, r.is_felt) for r in snapshots.scan_processed_union(spark, str(tmp_path)).collect()}
    assert rows == {"b": ("first", False), "c": ("second", False)}


def test_processed_table_prunes(spark, tmp_path):
    clean = clean_events(raw(spark, "a", "b").unionByName(raw(spark, "c", time_utc="2025-01-02T00:00:00")))
    sinks.sink_processed(clean, str(tmp_path / "t"), str(tmp_path / "csv"), "1")
    table = tables.scan_events_table(spark, str(tmp_path / "t"))
    assert table.schema.names == CLEAN.names and table.count() == 3
    plan = table.filter("year = 2025 and magnitude >= 5").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(magnitude,5.0)" in plan
    assert "ReadSchema: struct<event_id:string,magnitude:double>" in plan
    assert snapshots.scan_processed_union(spark, str(tmp_path / "csv")).count() == 3


def test_missing_features_say_what_to_do(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="build the features"):
        tables.scan_features(spark, str(tmp_path / "none"))


def test_stream_continues_and_keeps_late_rows(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    new = raw(spark, "a", "b", source="BMKG-terkini")
    old = raw(spark, "a", time_utc="2020-01-01T00:00:00").unionByName(raw(spark, "bad", magnitude="x"))
    for run, rows in (("1", new), ("2", old)):
        sinks.sink_raw_snapshot(rows, landing, run)
        ingest.append_screened(ingest.read_landing(spark, f"{landing}/*"), table, state).awaitTermination()
    rows = {r.event_id: r.source for r in ingest.read_screened(spark, table).collect()}
    assert rows == {"a": "USGS", "b": "BMKG-terkini"}
    assert spark.read.parquet(table).count() == 3


def test_merged_stream_gives_the_batch_answer(spark, tmp_path):
    """Late, better and repeated copies on several days, a run that stops before the files are listed, and a replay."""
    landing, table, state, merged = (str(tmp_path / n) for n in ("landing", "table", "state", "merged"))
    runs = [
        raw(spark, "a", "b", source="BMKG-terkini"),
        raw(spark, "a", time_utc="2020-01-01T00:00:00").unionByName(raw(spark, "bad", magnitude="x")),
        raw(spark, "b", time_utc="2021-05-05T00:00:00", source="BMKG-dirasakan").unionByName(raw(spark, "c")),
    ]
    columns = ["event_id", "source", "time_utc", "ingested_at"]
    for n, rows in enumerate(runs, start=1):
        sinks.sink_raw_snapshot(rows, landing, str(n))
        ingest.append_screened(ingest.read_landing(spark, f"{landing}/*"), table, state).awaitTermination()
        assert ingest.merge_screened(spark, table, merged) == n
        batch = ingest.read_screened(spark, table).select(columns).collect()
        assert sorted(ingest.read_merged(spark, merged).select(columns).collect()) == sorted(batch)
    assert ingest.merge_screened(spark, table, merged) is None
    moved = daily.read_log(spark, merged).filter("number = 2 and day is not null")
    assert moved.count() == 2  # the day it left and the day it came to

    before = sorted(ingest.read_merged(spark, merged).collect())
    merge_days(merged, spark.read.schema(RAW_TYPED).parquet(table), RAW_TYPED, dedup_source_priority)
    assert sorted(ingest.read_merged(spark, merged).collect()) == before
    assert daily.read_log(spark, merged).filter("number = 4 and day is not null").isEmpty()
    read = ingest.read_merged(spark, merged)
    plan = read._jdf.queryExecution().executedPlan().toString()
    # Rows meet the folded log, which is sent to them; only the log is shuffled.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan


def test_stream_dedup_in_flight(spark, tmp_path):
    landing = str(tmp_path / "landing")
    sinks.sink_raw_snapshot(raw(spark, "a", "a", "b"), landing, "1")
    once = ingest.dedup_within_watermark(ingest.read_landing(spark, f"{landing}/*"))
    q = (
        once.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "s"))
        .trigger(availableNow=True).start(str(tmp_path / "t"))
    )
    q.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b"]


def test_times_keep_their_fraction_and_manifest_counts_every_row(spark, tmp_path):
    rows = raw(spark, "a").withColumn("time_utc", F.lit("2024-01-01 00:00:00.987654").cast("timestamp"))
    bare = rows.withColumns({"event_id": F.lit(None).cast("string"), "time_utc": F.lit(None).cast("timestamp")})
    sinks.sink_raw_snapshot(rows.unionByName(bare), str(tmp_path), "20260101_000000")
    back = snapshots.scan_all_snapshots(spark, str(tmp_path))
    assert {r.time_utc for r in back.collect()} == {"2024-01-01T00:00:00.987654Z", None}
    assert sinks.manifest_rows(back, F.lit("now")).first().row_count == 2


def test_files_of_any_layout(spark, tmp_path):
    names = list(RAW_COLUMNS)
    write(tmp_path / "gempa_1.csv", ",".join(names) + "\n" + ",".join(f"a{n}" for n in range(len(names))) + "\n")
    write(tmp_path / "gempa_2.csv", ",".join(names[1:]) + "\n" + ",".join(f"b{n}" for n in range(1, len(names))) + "\n")
    moved = [*names[::-1], "further"]
    write(tmp_path / "gempa_3.csv", ",".join(moved) + "\n" + ",".join(f"c{n}" for n in range(len(moved))) + "\n")
    rows = {r.snapshot: r for r in snapshots.scan_all_snapshots(spark, str(tmp_path)).collect()}
    assert rows["gempa_1.csv"][names[0]] == "a0" and rows["gempa_1.csv"].further is None
    assert rows["gempa_2.csv"][names[0]] is None and rows["gempa_2.csv"][names[1]] == "b1"
    last = len(names) - 1
    assert rows["gempa_3.csv"][names[0]] == f"c{last}" and rows["gempa_3.csv"].further == f"c{last + 1}"
