"""Continuous bronze ingest as Structured Streaming.

The polling loop (fetch every N seconds; static domains only on the first
pass; a failing domain must not stop the others) becomes one streaming query
per domain over the landing folder:

* realtime domains: ``trigger(processingTime=...)`` at the poll interval;
* static domains: ``trigger(availableNow=True)`` -- process what is there, stop
  (``every_pass=True`` keeps them on the interval trigger instead);
* the checkpoint (in the shared checkpoint folder) replaces the iteration
  counter: a restarted or retried query resumes exactly where it stopped,
  and the file sink commits each micro-batch atomically;
* queries are independent, so one domain's failure is isolated, and ``supervise``
  starts a failed one again on its next pass.

``start_silver`` runs the silver operators on the same stream: rows are normalized,
judged and split into the valid and the rejected domain in one write.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules as R
from ..functions.schemas import STATIC_DOMAINS, WEATHER_ENVELOPE
from ..operators.projections import normalize_weather
from ..operators.quality import split_by_validity, weather_rules
from ..plans.registry import register
from ..plans.silver_queries import (_NORM, _SILVER_SELECT, SILVER_OUT, land_weather_bronze, ts_text)
from ..session import scratch_path
from ..sinks.writers import SILVER_PARTITIONS
from ..sources.adapters import AS_OF, BATCH_ID, OWNER
from ..sources.readers import BRONZE_GLOB, path_value, read_silver

POLL_INTERVAL = "300 seconds"


@dataclass
class DomainStream:
    domain: str
    landing: str
    sink: str
    checkpoint: str
    schema: T.StructType = WEATHER_ENVELOPE
    static: bool | None = None
    # Move committed source files here (outside ``landing``), so the per-trigger
    # listing stays small as files accumulate.  None keeps landed files in place.
    archive_dir: str | None = None


def envelope_stream(spark: SparkSession, landing: str, schema: T.StructType,
                    archive_dir: str | None = None) -> DataFrame:
    """Landed envelope JSON lines as a stream, with partition values from the path."""
    r = (spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
         .option("pathGlobFilter", BRONZE_GLOB).option("maxFilesPerTrigger", 10_000))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = r.json(landing)
    fp = F.col("_metadata.file_path")
    return df.select("*", fp.alias("file_path"), path_value(fp, "source").alias("landed_source"),
                     path_value(fp, "ingest_date", r"[0-9\-]+").alias("ingest_date"),
                     path_value(fp, "hour", "[0-9]{2}").alias("hour"))


def start_domain(spark: SparkSession, d: DomainStream, once: bool = False, every_pass: bool = False,
                 interval: str = POLL_INTERVAL) -> StreamingQuery:
    static = d.static if d.static is not None else d.domain in STATIC_DOMAINS
    w = (envelope_stream(spark, d.landing, d.schema, d.archive_dir).writeStream.format("parquet")
         .option("path", d.sink).option("checkpointLocation", d.checkpoint)
         .partitionBy("landed_source", "ingest_date", "hour")
         # one name per (domain, checkpoint): two ingests of a domain may run side by side
         .queryName(f"bronze_{d.domain}_{zlib.crc32(d.checkpoint.encode()):08x}"))
    if once or (static and not every_pass):
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=interval)
    return w.start()


def start_ingest(spark: SparkSession, streams: list[DomainStream], once: bool = False, every_pass: bool = False,
                 interval: str = POLL_INTERVAL) -> dict[str, StreamingQuery | str]:
    """Start one query per domain.  Returns the running query per domain, or the
    error text for a domain that failed to start (the others keep running)."""
    out: dict[str, StreamingQuery | str] = {}
    for d in streams:
        try:
            out[d.domain] = start_domain(spark, d, once, every_pass, interval)
        except Exception as exc:  # noqa: BLE001 - isolate the failing domain
            out[d.domain] = f"{type(exc).__name__}: {exc}"
    return out


def retry_failed(spark: SparkSession, streams: list[DomainStream], running: dict[str, StreamingQuery | str],
                 every_pass: bool = False, interval: str = POLL_INTERVAL) -> dict[str, StreamingQuery | str]:
    """The next pass: domains that failed to start, or whose query ended with an error,
    are started again from their checkpoint; the others go on untouched.  A static
    domain is retried only with ``every_pass``, as its one pass is over."""
    out = dict(running)
    for d in streams:
        q = running.get(d.domain)
        failed = isinstance(q, str) or q is not None and not q.isActive and q.exception() is not None
        static = d.static if d.static is not None else d.domain in STATIC_DOMAINS
        if failed and (every_pass or not static):
            out |= start_ingest(spark, [d], False, every_pass, interval)
    return out


def supervise(spark: SparkSession, streams: list[DomainStream], running: dict[str, StreamingQuery | str],
              go_on: Callable[[dict], bool], every_pass: bool = False, interval: str = POLL_INTERVAL,
              wait: float = 300.0) -> dict[str, StreamingQuery | str]:
    """Passes over the domains, ``wait`` seconds apart, while ``go_on(running)`` says so;
    on each, those that failed are started again (``retry_failed``)."""
    while go_on(running):
        time.sleep(wait)
        running = retry_failed(spark, streams, running, every_pass, interval)
    return running


def start_silver(spark: SparkSession, d: DomainStream, out_root: str, owner: str, as_of=None, batch_id: str = "stream",
                 once: bool = False, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Landed envelopes of a domain -> silver, continuously: the operators and the layout of the batch run.

    ``d.checkpoint`` is that of this query.  The sink's log under ``out_root`` names
    the files of committed batches, so a batch that is run again after a failure
    replaces what its first run left; read the table by ``out_root`` and filter on
    ``domain``, as a reader of single folders does not see that log."""
    rows = normalize_weather(envelope_stream(spark, d.landing, d.schema, d.archive_dir), batch_id, owner)
    split = split_by_validity(rows, R.all_of(weather_rules(owner, as_of)), d.domain)
    w = (split.writeStream.format("parquet").option("path", out_root).option("checkpointLocation", d.checkpoint)
         .partitionBy(*SILVER_PARTITIONS).queryName(f"silver_{d.domain}_{zlib.crc32(d.checkpoint.encode()):08x}"))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)).start()


def run_ingest(spark: SparkSession, streams: list[DomainStream], every_pass: bool = False,
               interval: str = POLL_INTERVAL) -> dict[str, str | None]:
    """One pass over everything landed (availableNow for every domain); waits
    for all queries and reports per-domain errors instead of raising."""
    status: dict[str, str | None] = {}
    for name, q in start_ingest(spark, streams, True, every_pass, interval).items():
        if isinstance(q, str):
            status[name] = q
            continue
        try:
            q.awaitTermination()
            status[name] = None if q.exception() is None else str(q.exception())
        except Exception as exc:  # noqa: BLE001
            status[name] = f"{type(exc).__name__}: {exc}"
    return status


@register("bronze_stream_ingest", """WITH w AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'current_api'
    ELSE 'archive_api' END AS source, strftime(ts, '%Y-%m-%d') AS ingest_date, strftime(ts, '%H') AS hour
    FROM events) SELECT source, ingest_date, hour, count(*) AS rows FROM w GROUP BY ALL""")
def q_bronze_stream_ingest(spark, sf_dir):
    """Stream the landed weather bronze once (availableNow) into a parquet sink; read the sink."""
    landing = land_weather_bronze(spark, sf_dir)
    base = scratch_path(spark, "stream")
    d = DomainStream("weather", landing, f"{base}/sink", f"{base}/checkpoint")
    status = run_ingest(spark, [d])
    if status.get("weather"):
        raise RuntimeError(status["weather"])
    out = spark.read.parquet(d.sink)
    return (out.groupBy(F.col("landed_source").cast("string").alias("source"),
                        F.date_format(F.col("ingest_date").cast("date"), "yyyy-MM-dd").alias("ingest_date"),
                        F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("silver_stream", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM valid")
def q_silver_stream(spark, sf_dir):
    """Stream the landed weather bronze once into silver; read the valid rows back."""
    base = scratch_path(spark, "silver-stream")
    d = DomainStream("weather", land_weather_bronze(spark, sf_dir), base, f"{base}-checkpoint")
    start_silver(spark, d, base, OWNER, AS_OF, BATCH_ID, once=True).awaitTermination()
    return ts_text(read_silver(spark, base, "parquet").filter("domain = 'weather'").select(*SILVER_OUT), "ingest_ts", "event_ts")
