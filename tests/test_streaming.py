"""Streaming ingest equals the batch read of the same landed files."""

import os

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.plans.silver_queries import run_silver
from strata.sources.readers import read_bronze, read_silver
from strata.streaming.ingest import DomainStream, run_ingest, start_ingest, start_silver, supervise

from .test_bronze_silver import _land, env


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env(), env(temp=2.0)])
    base = scratch_path(spark, "stream_test")
    d = DomainStream("weather", landing, f"{base}/sink", f"{base}/ck")
    assert run_ingest(spark, [d]) == {"weather": None}
    assert spark.read.parquet(d.sink).count() == read_bronze(spark, landing).count() == 2
    # new file arrives: the checkpoint resumes, old files are not re-read
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=10/b.jsonl", [env(temp=3.0)])
    assert run_ingest(spark, [d]) == {"weather": None}
    out = spark.read.parquet(d.sink)
    assert out.count() == 3
    assert sorted(r.t for r in out.select(F.col("payload.temperature_2m").alias("t")).collect()) == [1.0, 2.0, 3.0]


def test_failing_domain_is_isolated(spark, tmp_path):
    landing = str(tmp_path / "ok")
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env()])
    base = scratch_path(spark, "stream_iso")
    good = DomainStream("weather", landing, f"{base}/s1", f"{base}/c1")
    bad = DomainStream("alerts", str(tmp_path / "missing"), f"{base}/s2", f"{base}/c2")
    status = run_ingest(spark, [bad, good])
    assert status["weather"] is None and status["alerts"]
    assert os.path.isdir(str(tmp_path / "ok"))


def test_realtime_interval_and_static_once(spark, tmp_path):
    landing = str(tmp_path / "rt")
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env()])
    base = scratch_path(spark, "stream_rt")
    rt = DomainStream("weather", landing, f"{base}/w", f"{base}/cw")
    static = DomainStream("alerts", landing, f"{base}/a", f"{base}/ca")
    qs = start_ingest(spark, [rt, static], interval="1 second")
    try:
        qs["alerts"].awaitTermination(120)          # static domain: availableNow, stops by itself
        assert not qs["alerts"].isActive
        qs["weather"].processAllAvailable()        # realtime domain keeps polling
        assert qs["weather"].isActive
        _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=10/b.jsonl", [env(temp=5.0)])
        qs["weather"].processAllAvailable()
        assert spark.read.parquet(rt.sink).count() == 2
    finally:
        for q in qs.values():
            if not isinstance(q, str):
                q.stop()


def test_archive_option_runs(spark, tmp_path):
    landing = str(tmp_path / "arch_landing")
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env()])
    base = scratch_path(spark, "stream_arch")
    d = DomainStream("weather", landing, f"{base}/sink", f"{base}/ck", archive_dir=str(tmp_path / "archive"))
    assert run_ingest(spark, [d]) == {"weather": None}
    assert spark.read.parquet(d.sink).count() == 1


def test_failed_realtime_domain_is_retried(spark, tmp_path):
    from strata.streaming.ingest import retry_failed

    landing, base = str(tmp_path / "late"), scratch_path(spark, "stream_retry")
    rt = DomainStream("weather", landing, f"{base}/w", f"{base}/cw")
    static = DomainStream("alerts", str(tmp_path / "none"), f"{base}/a", f"{base}/ca")
    first = start_ingest(spark, [rt, static], interval="1 second")
    assert isinstance(first["weather"], str) and isinstance(first["alerts"], str)  # nothing has landed yet
    _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env()])
    second = retry_failed(spark, [rt, static], first, interval="1 second")
    try:
        assert second["alerts"] == first["alerts"]  # a static domain has had its pass
        second["weather"].processAllAvailable()
        assert spark.read.parquet(rt.sink).count() == 1
        assert retry_failed(spark, [rt, static], second)["weather"] is second["weather"]  # a healthy query goes on
    finally:
        second["weather"].stop()


def test_silver_stream_equals_the_batch_run_after_a_replay(spark, tmp_path):
    """A batch whose commit was lost runs again; a batch of later files follows; each row is there once."""
    landing = str(tmp_path / "landing")
    part = "domain=weather/source=s1/ingest_date=2024-01-01/hour=09"
    _land(landing, f"{part}/a.jsonl", [env(), env(temp=2.0), env(owner="nobody"), "no json"])
    as_of, out = "2024-06-01 00:00:00", str(tmp_path / "stream")
    d = DomainStream("weather", landing, out, str(tmp_path / "ck"))
    start_silver(spark, d, out, "owner", as_of, "b", once=True).awaitTermination()
    for name in ("0", ".0.crc"):
        os.remove(f"{d.checkpoint}/commits/{name}")
    _land(landing, "domain=weather/source=s2/ingest_date=2024-01-01/hour=10/b.jsonl", [env("s2", temp=3.0), env("s2", temp=999.0)])
    start_silver(spark, d, out, "owner", as_of, "b", once=True).awaitTermination()

    path = run_silver(spark, landing, str(tmp_path / "batch"), "b", "owner", as_of)["path"]
    cols = [c for c in read_silver(spark, path, "parquet").columns if c != "silver_file"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    whole = read_silver(spark, out, "parquet")
    assert rows(whole.filter("domain = 'weather'")) == rows(read_silver(spark, path, "parquet"))
    assert whole.filter("domain = 'weather_rejected'").count() == 3
    assert rows(whole.filter("domain = 'weather' AND hour = '10'")) == rows(read_silver(spark, path, "parquet").filter("hour = '10'"))
    assert whole.filter("hour = '10'").count() == 2


def test_a_failed_domain_is_started_again_on_the_next_pass(spark, tmp_path):
    landing, base = str(tmp_path / "later"), scratch_path(spark, "stream_supervise")
    d = DomainStream("weather", landing, f"{base}/w", f"{base}/cw")
    passes = []

    def go_on(running):
        passes.append(isinstance(running["weather"], str))
        if len(passes) == 2:  # the domain lands between two passes
            _land(landing, "domain=weather/source=s1/ingest_date=2024-01-01/hour=09/a.jsonl", [env()])
        return len(passes) < 4

    running = supervise(spark, [d], start_ingest(spark, [d], interval="1 second"), go_on, interval="1 second", wait=0.1)
    try:
        assert passes == [True, True, False, False]
        running["weather"].processAllAvailable()
        assert spark.read.parquet(d.sink).count() == 1
    finally:
        running["weather"].stop()
