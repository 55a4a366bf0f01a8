"""Bronze shaping and silver rules on hand-made payloads and files."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.schemas import CITIES
from strata.functions.timefmt import local_to_utc
from strata.operators.projections import drop_synthetic_columns, normalize_weather
from strata.operators.quality import valid_weather
from strata.plans.silver_queries import run_silver
from strata.session import local_path, scratch_path
from strata.sources.bronze import (csv_rows_to_envelopes, envelope_json, history_window, manifest, orphan_files,
                                   preferred_file, shape_weather_archive, shape_weather_current)
from strata.sources.readers import read_bronze, read_csv_dialect, read_rejected, read_silver


def item(lat=None, t="2024-01-01T10:00", temp=1.0):
    d = {"current": {"time": t, "temperature_2m": temp}, "current_units": {"temperature_2m": "C"}}
    if lat is not None:
        d["latitude"] = lat
    return d


def test_current_payload_shorter_longer_and_single(spark):
    rows = [(1, "F", json.dumps([item(1.0), item()])),
            (2, "F", json.dumps([item(float(i)) for i in range(12)])),
            (3, "F", json.dumps(item(7.0)))]
    df = spark.createDataFrame(rows, "response_id long, fetched_at string, raw string")
    out = shape_weather_current(df, keep=("response_id",)).select(
        "response_id", "city_pos", "payload.city", "payload.latitude", "payload.temperature_2m").collect()
    assert len(out) == 3 * len(CITIES)  # always one row per city
    r1 = {r.city_pos: r for r in out if r.response_id == 1}
    assert r1[0].latitude == 1.0 and r1[1].latitude == CITIES[1][1]  # missing key -> dimension value
    assert r1[2].temperature_2m is None and r1[2].latitude == CITIES[2][1]  # missing item
    r2 = {r.city_pos: r for r in out if r.response_id == 2}
    assert [r2[i].latitude for i in range(10)] == [float(i) for i in range(10)]  # extra items dropped
    r3 = {r.city_pos: r for r in out if r.response_id == 3}
    assert r3[0].latitude == 7.0 and r3[1].temperature_2m is None  # single object = item 0


def test_archive_arrays_driven_by_time(spark):
    pay = [{"latitude": 1.0, "hourly": {"time": ["a", "b", "c"], "temperature_2m": [1.0],
                                        "wind_speed_10m": [1.0, 2.0, 3.0, 4.0]}},
           {"hourly": {"time": []}}, {}]
    df = spark.createDataFrame([(1, "F", json.dumps(pay))], "response_id long, fetched_at string, raw string")
    out = shape_weather_archive(df).select("city_pos", "payload.event_time", "payload.temperature_2m",
                                           "payload.wind_speed_10m", "payload.city").collect()
    assert [(r.event_time, r.temperature_2m, r.wind_speed_10m) for r in out] == [
        ("a", 1.0, 1.0), ("b", None, 2.0), ("c", None, 3.0)]
    assert {r.city for r in out} == {CITIES[0][0]}


def test_empty_csv_gives_empty_output(spark, tmp_path):
    p = tmp_path / "alerts.csv"
    p.write_text("id,region\n")
    env = csv_rows_to_envelopes(read_csv_dialect(spark, str(tmp_path)), "F", "alerts_csv", "owner")
    assert env.count() == 0
    p.write_text('id,region\n1,"a, b"\n')
    row = csv_rows_to_envelopes(read_csv_dialect(spark, str(tmp_path)), "F", "alerts_csv", "owner").first()
    assert row.payload["region"] == "a, b" and row.domain == "alerts"


def test_csv_dialect_of_the_csv_module(spark, tmp_path):
    rows = [["1", "line one\nline two", 'say "hi", ok'], ["2", "", "x"], ["3", "a,b", ""]]
    with open(tmp_path / "alerts.csv", "w", newline="") as fh:
        csv.writer(fh).writerows([["id", "note", "more"], *rows])
    env = csv_rows_to_envelopes(read_csv_dialect(spark, str(tmp_path)), "F", "alerts_csv", "owner")
    assert sorted([r.payload["id"], r.payload["note"], r.payload["more"]] for r in env.collect()) == rows
    line = json.loads(env.select(envelope_json().alias("j")).orderBy("j").first().j)
    assert line["payload"] == dict(zip(("id", "note", "more"), rows[0])) and line["domain"] == "alerts"


def _land(root, rel, lines):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def env(source="s1", owner="owner", t="2024-01-01T10:00", temp=1.0):
    return json.dumps({"ingest_ts": "2024-01-01T09:00:00Z", "source": source, "domain": "weather",
                       "metadata": {"author_surname": owner},
                       "payload": {"city": "X", "latitude": 1.0, "longitude": 2.0, "temperature_2m": temp,
                                   "relative_humidity_2m": 50.0, "precipitation": 0.0, "wind_speed_10m": 0.0,
                                   "event_time": t}})


def test_bronze_read_rules_and_edge_rows(spark, tmp_path):
    root = str(tmp_path / "bronze")
    base = "domain=weather/source=s1/ingest_date=2024-01-01"
    _land(root, f"{base}/hour=09/part-1.jsonl", [env(), "{not json", env(source="s2"), env(temp=101.0),
                                                  env(t="2030-01-01T00:00"), env(owner="other")])
    _land(root, "domain=weather/source=s1/ingest_date=2024-01-01/nohour/part-2.jsonl", [env()])
    _land(root, f"{base}/hour=09/part-1.jsonl.meta.json", ['{"x": 1}'])  # sidecar is not data
    b = read_bronze(spark, root)
    assert b.count() == 7
    assert sorted(r.hour for r in b.select("hour").distinct().collect()) == ["", "09"]
    norm = normalize_weather(b, "batch", "owner")
    ok = valid_weather(norm, "owner", "2024-06-01 00:00:00")
    # valid: the first row, and the row in the folder without hour= ("" passes the not-null rule)
    assert ok.count() == 2
    assert {r.hour for r in ok.select("hour").collect()} == {"09", ""}


def test_all_rejected_batch_is_not_written(spark, tmp_path):
    root = str(tmp_path / "bronze")
    _land(root, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/part-1.jsonl", [env(owner="nobody")])
    out = str(tmp_path / "silver")
    res = run_silver(spark, root, out, as_of="2024-06-01 00:00:00")
    assert res["written"] is False and res["counts"] == {"s1": (1, 0)}
    assert not os.path.exists(local_path(res["path"]))


def test_silver_run_by_source(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    part = "ingest_date=2024-01-01/hour=09/part-1.jsonl"
    _land(root, f"domain=weather/source=s1/{part}", [env(), env()])
    _land(root, f"domain=weather/source=s2/{part}", [env(owner="nobody")])
    _land(root, f"domain=alerts/source=s1/{part}", [env(), env(), env()])  # another domain is not read
    as_of = "2024-06-01 00:00:00"
    for fmt in ("json", "parquet"):
        for _ in range(2):  # a rerun of the batch replaces its rows
            res = run_silver(spark, root, f"{out}/{fmt}", "b", as_of=as_of, fmt=fmt)
        assert res["counts"] == {"s1": (2, 2), "s2": (1, 0)} and res["written_sources"] == ["s1"]
        back = read_silver(spark, res["path"], fmt)
        assert [(r.source, r.schema_v, r.batch_id) for r in back.collect()] == [("s1", 1, "b-s1")] * 2
        assert "/domain=weather/source=s1/schema_v=1/batch_id=b-s1/ingest_date=2024-01-01/hour=09/" in back.first().silver_file
        turned = read_rejected(spark, res["rejected_path"], fmt).collect()
        assert [(r.author_surname, r.domain, r.source, r.batch_id, r.hour) for r in turned] == [
            ("nobody", "weather", "s1", "b-s2", "09")]  # what the record says, and the batch of the folder it was found in
        _land(root, f"domain=weather/source=s1/{part}", [env(), env(owner="nobody"), "no json"])
        again = run_silver(spark, root, f"{out}/{fmt}", "b", as_of=as_of, fmt=fmt)
        assert again["counts"] == {"s1": (3, 1), "s2": (1, 0)}  # the folders of the batch hold this run's rows only
        assert read_silver(spark, res["path"], fmt).count() == 1 and read_rejected(spark, res["rejected_path"], fmt).count() == 3
        _land(root, f"domain=weather/source=s1/{part}", [env(), env()])
    with pytest.raises(FileNotFoundError):
        run_silver(spark, root, out, sources=["s1", "s3"], as_of=as_of)
    with pytest.raises(FileNotFoundError):
        run_silver(spark, root, out, domain="traffic", as_of=as_of)


def test_silver_reads_are_pruned_by_the_path(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for source in ("s1", "s2"):
        for hour in ("09", "10"):
            _land(root, f"domain=weather/source={source}/ingest_date=2024-01-01/hour={hour}/part-1.jsonl", [env(source)])
    for fmt in ("json", "parquet"):
        path = run_silver(spark, root, f"{out}/{fmt}", "b", as_of="2024-06-01 00:00:00", fmt=fmt)["path"]
        back = read_silver(spark, path, fmt)
        nine = back.filter("hour = '09' AND source = 's2'")
        assert [(r.source, r.hour, r.ingest_date, r.domain) for r in nine.collect()] == [("s2", "09", "2024-01-01", "weather")]
        plan = nine._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters:"):].split("]")[0]
        assert "hour" in filters and "source" in filters
        assert sorted((r.source, r.hour) for r in back.collect()) == [("s1", "09"), ("s1", "10"), ("s2", "09"), ("s2", "10")]
        one = read_silver(spark, f"{path}/source=s1", fmt)  # a folder of the table has its path columns too
        assert {(r.domain, r.source, r.schema_v, r.batch_id) for r in one.collect()} == {("weather", "s1", 1, "b-s1")}


def test_null_payload_keeps_the_cities(spark):
    df = spark.createDataFrame([(1, "F", None)], "response_id long, fetched_at string, raw string")
    out = shape_weather_current(df).select("payload.city", "payload.temperature_2m").collect()
    assert [r.city for r in out] == [c[0] for c in CITIES] and all(r.temperature_2m is None for r in out)


def test_dst_gap_and_fold(spark):
    df = spark.createDataFrame([("2024-03-31T03:30",), ("2024-10-27T03:30",), ("bad",)], "t string")
    got = [r.u for r in df.select(F.date_format(local_to_utc(F.col("t")), "yyyy-MM-dd HH:mm").alias("u")).collect()]
    # gap: 03:30 does not exist in Kyiv on 2024-03-31 -> shifted like the JVM does; fold: earlier offset
    assert got == ["2024-03-31 01:30", "2024-10-27 00:30", None]


def test_drop_synthetic_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "`Unnamed: 0` int, _c5 int, a int, `` int, _city int")
    assert drop_synthetic_columns(df).columns == ["a", "_city"]


def test_preferred_file_priority_and_none(spark):
    listing = spark.createDataFrame([("datasets/x_official.csv", 0), ("b/official_en.csv", 1),
                                     ("c/official_data_en.csv", 2), ("d/official_data_en.csv", 3)], "path string, pos long")
    assert preferred_file(listing).first().path == "c/official_data_en.csv"
    only_fallback = listing.where("pos = 0")
    assert preferred_file(only_fallback).first().priority == 2
    assert preferred_file(spark.createDataFrame([("x.json", 0)], "path string, pos long")).count() == 0


def test_history_window_bounds(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-10 23:00:00',"
                   " INTERVAL 1 HOUR)) AS ts")
    days = lambda n: sorted({r.d for r in history_window(df, "ts", "2024-01-05", n)
                             .select(F.to_date("ts").cast("string").alias("d")).collect()})
    assert days(3) == ["2024-01-03", "2024-01-04", "2024-01-05"]
    assert days(0) == days(1) == ["2024-01-05"]
    plan = history_window(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "2024-01-05", 2) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_manifest_and_orphans(spark):
    files = spark.createDataFrame([("/r/domain=weather/source=s1/ingest_date=d/hour=01/a.txt", "T")],
                                  "file_path string, fetched_at string")
    m = manifest(files, "owner", {"s1": "http://u"}, "application/json").first()
    assert (m.domain, m.source, m.source_url, m.stored_file) == ("weather", "s1", "http://u", "a.txt")
    listing = spark.createDataFrame([("/r/domain=weather/source=s1/ingest_date=d/hour=01/a.txt",),
                                     ("/r/domain=roads/source=s1/ingest_date=d/hour=01/a.txt",)], "file_path string")
    assert [r.file_path for r in orphan_files(listing, manifest(files, "o", {}, "x")).collect()] == [
        "/r/domain=roads/source=s1/ingest_date=d/hour=01/a.txt"]


def test_scratch_path_is_under_checkpoint_dir(spark):
    ck = spark.sparkContext.getCheckpointDir()
    assert ck and scratch_path(spark, "t").startswith(ck.rsplit("/", 1)[0])


def test_reference_style_landing(spark, tmp_path):
    """Files named and shaped like the reference lands them: JSONL + sidecar,
    a pretty-printed roads document, an opaque .pb, alerts rows with any header."""
    from strata.functions.schemas import ALERTS_ENVELOPE
    from strata.plans.bronze_queries import read_documents
    from strata.sources.readers import landed_files, read_manifests

    root = str(tmp_path / "bronze")
    part = "ingest_date=2026-04-21/hour=09"
    _land(root, f"domain=weather/source=s1/{part}/part-20260421T094116Z.jsonl", [env()])
    side = {"author_surname": "owner", "domain": "weather", "source": "s1", "source_url": "u",
            "fetched_at": "2026-04-21T09:41:16Z", "content_type": "application/json",
            "stored_file": "part-20260421T094116Z.jsonl"}
    _land(root, f"domain=weather/source=s1/{part}/part-20260421T094116Z.jsonl.meta.json", [json.dumps(side, indent=2)])
    doc = {"ingest_ts": "2026-04-21T09:41:16Z", "source": "osm", "domain": "roads", "metadata": {"author_surname": "o"},
           "payload": {"generator": "g", "elements": [{"type": "way", "id": 1}, {"type": "node", "id": 2}]}}
    _land(root, f"domain=roads/source=osm/{part}/part-20260421T094116Z.json", [json.dumps(doc, indent=2)])
    _land(root, f"domain=roads/source=osm/{part}/part-20260421T094116Z.json.meta.json",
          [json.dumps({**side, "domain": "roads", "stored_file": "part-20260421T094116Z.json"}, indent=2)])
    os.makedirs(os.path.join(root, f"domain=traffic/source=gtfs/{part}"), exist_ok=True)
    with open(os.path.join(root, f"domain=traffic/source=gtfs/{part}/part-20260421T094116Z.pb"), "wb") as fh:
        fh.write(b"\x00\x01\x02")
    alert = {"ingest_ts": "T", "source": "a", "domain": "alerts", "metadata": {"author_surname": "o"},
             "payload": {"oblast": "X", "started_at": "2022-02-24"}}
    _land(root, f"domain=alerts/source=a/{part}/part-20260421T094116Z.jsonl", [json.dumps(alert)])

    assert read_bronze(spark, f"{root}/domain=weather").count() == 1          # sidecar not read as data
    d = read_documents(spark, f"{root}/domain=roads").first()
    assert d.domain == "roads" and d.payload.toPython() == doc["payload"]
    a = read_bronze(spark, f"{root}/domain=alerts", ALERTS_ENVELOPE).first()
    assert a.payload["oblast"] == "X"
    files = landed_files(spark, root)
    assert files.count() == 4
    m = read_manifests(spark, root)
    assert m.count() == 2
    orphans = orphan_files(files, m)
    assert sorted(r.file_path.split("/domain=")[1] for r in orphans.collect()) == [
        "alerts/source=a/ingest_date=2026-04-21/hour=09/part-20260421T094116Z.jsonl",
        "traffic/source=gtfs/ingest_date=2026-04-21/hour=09/part-20260421T094116Z.pb"]


def test_sidecar_files_beside_the_data(spark, tmp_path):
    """After a write that failed in one of its tasks and a second one, every file has its sidecar and nothing else is left."""
    from strata.sinks.files import write_sidecar_files
    from strata.sources.readers import landed_files, read_manifests

    root = str(tmp_path / "bronze")
    for k in range(12):
        _land(root, f"domain=weather/source=s{k % 3}/ingest_date=2024-01-0{k % 4 + 1}/hour=09/part-{k}.jsonl", [env()])
    files = landed_files(spark, root, "*.jsonl").select("file_path", F.lit("2024-01-01T09:00:00Z").alias("fetched_at"))
    records = manifest(files, "owner", {"s1": "http://u"}, "application/json")
    nowhere = manifest(spark.createDataFrame([(f"file:{root}/none/x.jsonl", "t")], "file_path string, fetched_at string"), "owner", {}, "x")
    with pytest.raises(Exception):  # noqa: B017 - the failure of a task
        write_sidecar_files(records.unionByName(nowhere))
    for _ in range(2):  # a second write replaces them by equal ones
        write_sidecar_files(records.unionByName(records))
        names = [n for _, _, found in os.walk(root) for n in found]
        assert sorted(n for n in names if not n.endswith(".crc")) == sorted([f"part-{k}.jsonl{x}" for k in range(12) for x in ("", ".meta.json")])
    back = read_manifests(spark, root)
    assert orphan_files(files, back).count() == 0 and back.count() == 12
    got = {r.stored_file: r for r in back.collect()}
    assert got["part-4.jsonl"].source == "s1" and got["part-4.jsonl"].source_url == "http://u"
    assert got["part-3.jsonl"].source_url is None and got["part-3.jsonl"].content_type == "application/json"
    path = f"{root}/domain=weather/source=s1/ingest_date=2024-01-01/hour=09/part-4.jsonl.meta.json"
    assert list(json.load(open(path))) == ["author_surname", "domain", "source", "source_url", "fetched_at", "content_type", "stored_file"]
    assert read_bronze(spark, root).count() == 12  # sidecars are no data
    with pytest.raises(Exception, match="file_path"):
        write_sidecar_files(records.limit(1).withColumn("file_path", F.lit(None).cast("string")))


def test_blobs_land_as_files(spark, tmp_path):
    """Files of no, one and several blocks; a copy that fails leaves nothing."""
    from strata.sinks import files

    (tmp_path / "in").mkdir()
    sizes = {"empty.pb": 0, "one.pb": 1000, "edge.pb": files.BLOCK, "many.pb": 2 * files.BLOCK + 17}
    for name, n in sizes.items():
        (tmp_path / "in" / name).write_bytes(os.urandom(n))
    listing = spark.createDataFrame([(f"file:{tmp_path}/in/{n}", f"file://{tmp_path}/out/a=1/{n}") for n in sizes],
                                    "file_path string, target string")
    got = files.land_files(listing.union(listing), f"{tmp_path}/log").collect()
    assert {r.target.rpartition("/")[2]: r.length for r in got} == sizes and len(got) == 4 and all(r.unchanged for r in got)
    for name in sizes:
        assert (tmp_path / "out" / "a=1" / name).read_bytes() == (tmp_path / "in" / name).read_bytes()
    assert files.land_files(listing.limit(0), f"{tmp_path}/log0").count() == 0
    one = f"file://{tmp_path}/out/b=1/x.pb"
    with pytest.raises(Exception, match="not one file"):
        files.land_files(listing.withColumn("target", F.lit(one)), f"{tmp_path}/log1")
    gone = spark.createDataFrame([(f"file:{tmp_path}/in/none.pb", one)], "file_path string, target string")
    with pytest.raises(Exception):  # noqa: B017 - the failure of a task
        files.land_files(gone, f"{tmp_path}/log2")
    assert not os.path.exists(tmp_path / "out" / "b=1") or os.listdir(tmp_path / "out" / "b=1") == []


def test_blobs_of_tables_in_folders_land_all(spark, tmp_path):
    """Files of several tables that have the same names."""
    import __spark_entry__ as e

    for t in ("a", "b"):
        (tmp_path / "tables" / f"{t}.parquet").mkdir(parents=True)
        for k in range(2):
            (tmp_path / "tables" / f"{t}.parquet" / f"part-{k}.parquet").write_bytes(f"{t}{k}".encode() * 100)
    (tmp_path / "tables" / "c.parquet").write_bytes(b"c")
    rows = e.queries()["bronze_binary_landing"](spark, f"file:{tmp_path}/tables").collect()
    assert sorted(r.file_name for r in rows) == ["a.parquet/part-0.parquet", "a.parquet/part-1.parquet", "b.parquet/part-0.parquet",
                                                 "b.parquet/part-1.parquet", "c.parquet"]
    assert all(r.unchanged for r in rows) and len({r.content_md5 for r in rows}) == 5


def test_blobs_that_only_spark_reads(spark, tmp_path):
    """Any bytes, with and without a last line end, with a byte order mark, in one split and in many."""
    import hashlib

    from strata.sinks import files

    blobs = {"random": os.urandom(300_001), "closed": os.urandom(70_000) + b"\n", "mark": files.BOM + b"x\ny", "marked": files.BOM + b"x\r\n",
             "two": files.BOM * 2 + b"\n", "ends": b"\n" * 50_000, "one": b"\0" * 90_000, "short": b"\r", "only": files.BOM, "cr": b"a\r\nb\rc\r" * 9_000}
    for n, content in blobs.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / n).write_bytes(content)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.blobs.link./in", f"file://{tmp_path}/in")
    listing = spark.createDataFrame([(f"viewfs://blobs/in/{n}", f"file://{tmp_path}/out/{n}") for n in blobs], "file_path string, target string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = files.land_files(listing, f"file://{tmp_path}/log", "viewfs://blobs/in").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.target.rpartition("/")[2]: (r.length, r.content_md5, r.unchanged) for r in got} == {
        n: (len(c), hashlib.md5(c).hexdigest(), True) for n, c in blobs.items()}
    assert all((tmp_path / "out" / n).read_bytes() == c for n, c in blobs.items())
    with pytest.raises(ValueError, match="viewfs"):
        files.land_files(listing, f"file://{tmp_path}/log2")


def test_lines_are_written_without_sorting_them_by_folder(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from strata.sinks import writers

    seen, before = {}, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    for name in ("json", "text"):
        one = getattr(DataFrameWriter, name)

        def write(self, path, *a, name=name, one=one, **kw):
            plan = spark.sql("EXPLAIN INSERT INTO lines_by_day SELECT * FROM lines_of_days").first()[0]
            seen[name] = "WriteFiles" in plan and "Sort" not in plan
            return one(self, path, *a, **kw)
        monkeypatch.setattr(DataFrameWriter, name, write)
    df = spark.range(3000).selectExpr("concat('line ', id) AS value", "concat('d', id % 300) AS day")
    df.createOrReplaceTempView("lines_of_days")
    spark.sql(f"CREATE TABLE lines_by_day (value string, day string) USING json PARTITIONED BY (day) LOCATION 'file://{tmp_path}/t'")
    try:
        writers.land_text(df, "value", f"file://{tmp_path}/text", ["day"])
        writers.write_silver_jsonl(df, f"file://{tmp_path}/json", ["day"])
    finally:
        spark.sql("DROP TABLE lines_by_day")
    assert seen == {"json": True, "text": True}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    want = sorted(tuple(r) for r in df.collect())
    # more folders than files that a task holds open
    assert sorted(tuple(r) for r in spark.read.text(f"file://{tmp_path}/text").collect()) == want
    assert sorted((r.value, r.day) for r in spark.read.json(f"file://{tmp_path}/json").collect()) == want
