"""Silver layer: landed weather envelopes -> normalized, validated, written, audited."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules as R
from ..functions.schemas import MEASURES, SILVER_WEATHER
from ..functions.timefmt import local_to_utc, parse_iso_ts
from ..operators.profile import rows_by_city_top, rows_by_source, silver_distincts
from ..operators.projections import normalize_weather
from ..operators.quality import audit_silver, rejected_domain, source_gate, split_by_validity, valid_weather, weather_rules
from ..session import input_key, scratch_path
from ..sinks.writers import (SILVER_PARTITIONS, batch_folder, delete_folders, existing_folders, land_text, write_silver_jsonl,
                             write_silver_parquet)
from ..sources.adapters import AS_OF, BATCH_ID, OWNER, weather_records
from ..sources.bronze import partition_columns, partition_dir
from ..sources.readers import landed_sources, read_bronze, read_rejected, read_silver
from .oracle_sql import WEATHER
from .registry import register

BRONZE_PARTITIONS = ["domain", "source", "ingest_date", "hour"]
_LANDED: dict = {}
_SILVER: dict = {}


def ts_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


def weather_envelopes(w: DataFrame) -> DataFrame:
    """Flat observations -> (JSON envelope line, partition columns)."""
    payload = F.struct("city", "latitude", "longitude", "elevation", "timezone", "timezone_abbreviation",
                       *MEASURES, "event_time")
    env = F.to_json(F.struct("ingest_ts", "source", "domain", F.struct("author_surname").alias("metadata"),
                             payload.alias("payload")))
    return w.select(env.alias("value"), "domain", "source", *partition_columns(F.col("ingest_ts")))


def land_weather_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Land the weather observations as bronze JSON lines under
    ``domain=/source=/ingest_date=/hour=`` (once per session and input)."""
    key = input_key(spark, sf_dir)
    if key not in _LANDED:
        root = scratch_path(spark, "bronze")
        land_text(weather_envelopes(weather_records(spark, sf_dir)), "value", root, BRONZE_PARTITIONS)
        _LANDED[key] = root
    return _LANDED[key]


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_weather(read_bronze(spark, land_weather_bronze(spark, sf_dir)), BATCH_ID, OWNER)


def run_silver(spark: SparkSession, bronze_root: str, out_root: str, batch_id: str = BATCH_ID,
               owner: str = OWNER, as_of=AS_OF, fmt: str = "parquet", domain: str = "weather",
               sources: list[str] | None = None) -> dict:
    """The sources of a domain in one write: each line is parsed and judged once.

    Only files of ``domain`` and ``sources`` (default: all landed ones) are read; a
    source without landed files is an error.  Each source has a batch id of its own,
    and one without valid rows writes none.  Layout:
    ``<out>/domain=<d>/source=<s>/schema_v=1/batch_id=<id>-<s>/ingest_date=<d>/hour=<h>``;
    the columns of the path are read back from there.  Rejected rows land beside them
    under ``domain=<d>_rejected``, with the domain and source they were found with in
    ``found_domain`` and ``found_source`` (null in valid rows).  A rerun replaces its
    batch.  Rows are counted in what was written, for Parquet from the footers.
    """
    landed = landed_sources(spark, bronze_root, domain)
    wanted = landed if sources is None else list(sources)
    if missing := sorted(set(wanted) - set(landed)) or ([domain] if not wanted else []):
        raise FileNotFoundError(f"No bronze JSON-lines files of {missing} found under {bronze_root}")
    folders = [f"{bronze_root}/domain={domain}/source={s}" for s in wanted]
    norm = normalize_weather(read_bronze(spark, folders), batch_id, owner)
    split, rejected = split_by_validity(norm, R.all_of(weather_rules(owner, as_of)), domain), rejected_domain(domain)

    batches = [batch_folder(out_root, d, s, batch_id) for d in (domain, rejected) for s in wanted]
    delete_folders(spark, batches)
    write = write_silver_parquet if fmt == "parquet" else write_silver_jsonl
    write(split, out_root, SILVER_PARTITIONS)
    rows = {}
    if there := existing_folders(spark, batches):
        kept = spark.read.schema("domain string, source string").option("basePath", out_root).format(fmt).load(there)
        rows = {(r["domain"], r["source"]): r["count"] for r in kept.groupBy("domain", "source").count().collect()}
    counts = {s: (rows.get((domain, s), 0) + rows.get((rejected, s), 0), rows.get((domain, s), 0)) for _, s in rows}
    written = sorted(s for s, (_, n) in counts.items() if n)
    return {"path": f"{out_root}/domain={domain}", "counts": counts, "written": bool(written), "written_sources": written,
            "rejected_path": f"{out_root}/domain={rejected}" if any(d == rejected for d, _ in rows) else None}


def silver_run(spark: SparkSession, sf_dir: str, fmt: str) -> dict:
    key = (*input_key(spark, sf_dir), fmt)
    if key not in _SILVER:
        _SILVER[key] = run_silver(spark, land_weather_bronze(spark, sf_dir), scratch_path(spark, "silver"), fmt=fmt)
    return _SILVER[key]


def silver_back(spark: SparkSession, sf_dir: str, fmt: str = "json") -> DataFrame:
    return read_silver(spark, silver_run(spark, sf_dir, fmt)["path"], fmt)


def rejected_back(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """Rows that the run turned away; none where it turned none away."""
    path = silver_run(spark, sf_dir, fmt)["rejected_path"]
    return read_rejected(spark, path, fmt) if path else spark.createDataFrame([], SILVER_WEATHER)


SILVER_OUT = ["author_surname", "domain", "source", "ingest_ts", "event_ts", "city", "latitude", "longitude",
              "elevation", "timezone", "timezone_abbreviation", *MEASURES, "ingest_date", "hour", "schema_v",
              "batch_id", "processed_author_surname", "processed_source"]

# --- oracle fragments ---------------------------------------------------------
_RULES = """author_surname IS NOT NULL AND domain IS NOT NULL AND source IS NOT NULL
  AND ingest_ts IS NOT NULL AND event_ts IS NOT NULL AND city IS NOT NULL AND latitude IS NOT NULL
  AND longitude IS NOT NULL AND temperature_2m IS NOT NULL AND relative_humidity_2m IS NOT NULL
  AND precipitation IS NOT NULL AND wind_speed_10m IS NOT NULL AND ingest_date IS NOT NULL AND hour IS NOT NULL
  AND author_surname = 'owner' AND domain = 'weather'
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND temperature_2m BETWEEN -100 AND 100
  AND relative_humidity_2m BETWEEN 0 AND 100 AND precipitation >= 0 AND wind_speed_10m >= 0"""
_NORM = f"""w AS ({WEATHER}),
norm AS (SELECT author_surname, domain, source,
  CAST(try_strptime(ingest_ts, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ingest_ts,
  timezone('UTC', timezone('Europe/Kyiv', try_strptime(event_time, '%Y-%m-%dT%H:%M'))) AS event_ts,
  city, latitude, longitude, elevation, timezone, timezone_abbreviation,
  temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, ingest_date, hour,
  1 AS schema_v, concat('batch-0001-', source) AS batch_id, 'owner' AS processed_author_surname, source AS processed_source
  FROM w),
valid AS (SELECT * FROM norm WHERE {_RULES} AND source = processed_source AND event_ts <= TIMESTAMP '{AS_OF}'),
rejected AS (SELECT * FROM norm
  WHERE ({_RULES} AND source = processed_source AND event_ts <= TIMESTAMP '{AS_OF}') IS NOT TRUE)"""


def _ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


_SILVER_SELECT = ", ".join(_ts(c) + f" AS {c}" if c in ("ingest_ts", "event_ts") else c for c in SILVER_OUT)


@register("read_bronze", f"""WITH w AS ({WEATHER}) SELECT author_surname, domain, source, ingest_ts, city,
    latitude, longitude, elevation, timezone, timezone_abbreviation, temperature_2m, relative_humidity_2m,
    precipitation, wind_speed_10m, event_time, ingest_date, hour FROM w""")
def q_read_bronze(spark, sf_dir):
    b = read_bronze(spark, land_weather_bronze(spark, sf_dir))
    return b.select(F.col("metadata.author_surname").alias("author_surname"), "domain", "source", "ingest_ts",
                    "payload.city", "payload.latitude", "payload.longitude", "payload.elevation",
                    "payload.timezone", "payload.timezone_abbreviation", *[f"payload.{m}" for m in MEASURES],
                    "payload.event_time", "ingest_date", "hour")


@register("normalize_weather", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM norm")
def q_normalize_weather(spark, sf_dir):
    return ts_text(normalized(spark, sf_dir).select(*SILVER_OUT), "ingest_ts", "event_ts")


@register("local_to_utc", f"""WITH w AS ({WEATHER}) SELECT event_id, event_time,
    {_ts("timezone('UTC', timezone('Europe/Kyiv', try_strptime(event_time, '%Y-%m-%dT%H:%M')))")} AS event_ts
    FROM w""")
def q_local_to_utc(spark, sf_dir):
    w = weather_records(spark, sf_dir)
    return ts_text(w.select("event_id", "event_time", local_to_utc(F.col("event_time")).alias("event_ts")),
                   "event_ts")


@register("parse_iso_ts", f"""WITH w AS ({WEATHER}) SELECT event_id,
    {_ts("CAST(try_strptime(ingest_ts, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP)")} AS ingest_ts FROM w""")
def q_parse_iso_ts(spark, sf_dir):
    w = weather_records(spark, sf_dir)
    return ts_text(w.select("event_id", parse_iso_ts(F.col("ingest_ts")).alias("ingest_ts")), "ingest_ts")


@register("path_partition_extract", f"""WITH w AS ({WEATHER}) SELECT source, ingest_date, hour,
    count(*) AS rows FROM w GROUP BY source, ingest_date, hour""")
def q_path_partition_extract(spark, sf_dir):
    b = read_bronze(spark, land_weather_bronze(spark, sf_dir))
    src = F.regexp_extract("file_path", "source=([^/]+)", 1)
    return b.groupBy(src.alias("source"), "ingest_date", "hour").agg(F.count(F.lit(1)).alias("rows"))


@register("bronze_partition_path", f"""WITH w AS ({WEATHER}) SELECT event_id, ingest_date, hour,
    concat('domain=', domain, '/source=', source, '/ingest_date=', ingest_date, '/hour=', hour) AS partition_dir
    FROM w""")
def q_bronze_partition_path(spark, sf_dir):
    w = weather_records(spark, sf_dir).select("event_id", "domain", "source", *partition_columns(F.col("ingest_ts")))
    return w.select("event_id", "ingest_date", "hour",
                    partition_dir(F.col("domain"), F.col("source"), F.col("ingest_date"), F.col("hour"))
                    .alias("partition_dir"))


@register("valid_weather", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM valid")
def q_valid_weather(spark, sf_dir):
    return ts_text(valid_weather(normalized(spark, sf_dir), OWNER, AS_OF).select(*SILVER_OUT),
                   "ingest_ts", "event_ts")


@register("multi_source_run", f"""WITH {_NORM}, t AS (SELECT processed_source AS source, count(*) AS rows_total
    FROM norm GROUP BY 1), v AS (SELECT processed_source AS source, count(*) AS rows_valid FROM valid GROUP BY 1)
    SELECT t.source, rows_total, coalesce(rows_valid, 0) AS rows_valid,
           rows_total - coalesce(rows_valid, 0) AS rows_rejected FROM t LEFT JOIN v USING (source)""")
def q_multi_source_run(spark, sf_dir):
    cond = R.all_of(weather_rules(OWNER, AS_OF))
    return (normalized(spark, sf_dir).groupBy(F.col("processed_source").alias("source"))
            .agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(cond).alias("rows_valid"))
            .withColumn("rows_rejected", F.col("rows_total") - F.col("rows_valid")))


@register("skip_empty", f"""WITH {_NORM}, t AS (SELECT processed_source AS source, count(*) AS n FROM norm GROUP BY 1),
    v AS (SELECT processed_source AS source, count(*) AS n FROM valid GROUP BY 1)
    SELECT t.source, t.n AS rows_total, coalesce(v.n, 0) AS rows_valid, coalesce(v.n, 0) = 0 AS skipped
    FROM t LEFT JOIN v USING (source)
    UNION ALL SELECT 'replay_api', count(*), 0, true FROM norm HAVING count(*) > 0""")
def q_skip_empty(spark, sf_dir):
    """The write gate of a run: a source is skipped when it has no valid row, like
    the replay folder here, whose records name other sources."""
    norm = normalized(spark, sf_dir)
    replay = norm.withColumn("processed_source", F.lit("replay_api"))
    return source_gate(norm.unionByName(replay), R.all_of(weather_rules(OWNER, AS_OF)))


@register("lineage_columns", f"""WITH {_NORM} SELECT schema_v, batch_id, processed_author_surname,
    processed_source, count(*) AS rows FROM norm GROUP BY ALL""")
def q_lineage_columns(spark, sf_dir):
    return (normalized(spark, sf_dir).groupBy("schema_v", "batch_id", "processed_author_surname", "processed_source")
            .agg(F.count(F.lit(1)).alias("rows")))


@register("write_silver_parquet", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM valid")
def q_write_silver_parquet(spark, sf_dir):
    return ts_text(silver_back(spark, sf_dir, "parquet").select(*SILVER_OUT), "ingest_ts", "event_ts")


@register("write_silver_jsonl", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM valid")
def q_write_silver_jsonl(spark, sf_dir):
    return ts_text(silver_back(spark, sf_dir, "json").select(*SILVER_OUT), "ingest_ts", "event_ts")


@register("read_silver", f"""WITH {_NORM} SELECT {_SILVER_SELECT},
    concat('batch_id=', batch_id, '/ingest_date=', ingest_date, '/hour=', hour) AS silver_partition FROM valid""")
def q_read_silver(spark, sf_dir):
    back = silver_back(spark, sf_dir, "json")
    part = F.regexp_extract("silver_file", r"(batch_id=[^/]+/ingest_date=[^/]+/hour=[^/]+)/", 1)
    return ts_text(back.select(*SILVER_OUT, part.alias("silver_partition")), "ingest_ts", "event_ts")


@register("audit_silver", f"""WITH {_NORM} SELECT count(*) AS valid_rows, CAST(0 AS BIGINT) AS invalid_rows,
    count(*) > 0 AS passed FROM valid""")
def q_audit_silver(spark, sf_dir):
    """The columnar form is audited: only the columns of the rules are read."""
    return audit_silver(silver_back(spark, sf_dir, "parquet"), OWNER)


@register("rows_by_source", f"WITH {_NORM} SELECT source, count(*) AS rows FROM valid GROUP BY source")
def q_rows_by_source(spark, sf_dir):
    return rows_by_source(silver_back(spark, sf_dir, "json"))


@register("rows_by_city_top10", f"""WITH {_NORM} SELECT city, count(*) AS rows FROM valid GROUP BY city
    ORDER BY rows DESC, city LIMIT 10""")
def q_rows_by_city_top10(spark, sf_dir):
    return rows_by_city_top(silver_back(spark, sf_dir, "json"), 10)


@register("silver_distincts", f"""WITH {_NORM} SELECT 'author_surname' AS kind, author_surname AS value
    FROM valid GROUP BY 2 UNION ALL SELECT 'schema_v', CAST(schema_v AS VARCHAR) FROM valid GROUP BY 2
    UNION ALL SELECT 'batch_id', batch_id FROM valid GROUP BY 2
    UNION ALL SELECT 'n_batches', CAST(count(DISTINCT batch_id) AS VARCHAR) FROM valid""")
def q_silver_distincts(spark, sf_dir):
    return silver_distincts(silver_back(spark, sf_dir, "json"))


@register("write_layout", f"""WITH {_NORM} SELECT concat('weather/source=', source, '/schema_v=1/batch_id=', batch_id)
    AS folder, ingest_date, hour, count(*) AS rows FROM valid GROUP BY ALL""")
def q_write_layout(spark, sf_dir):
    """Rows by the folder they were written to, and whether the folder is the one their own columns name."""
    back = silver_back(spark, sf_dir, "parquet")
    folder = F.regexp_extract("silver_file", r"domain=([^/]+/source=[^/]+/schema_v=[^/]+/batch_id=[^/]+)/", 1)
    return back.groupBy(folder.alias("folder"), "ingest_date", "hour").agg(F.count(F.lit(1)).alias("rows"))


@register("rejected_weather", f"WITH {_NORM} SELECT {_SILVER_SELECT} FROM rejected")
def q_rejected_weather(spark, sf_dir):
    """What the silver run turned away, read back from where it landed."""
    return ts_text(rejected_back(spark, sf_dir).select(*SILVER_OUT), "ingest_ts", "event_ts")


@register("audit_rejected", f"""WITH {_NORM} SELECT count(*) FILTER ({_RULES}) AS valid_rows,
    count(*) FILTER (({_RULES}) IS NOT TRUE) AS invalid_rows,
    count(*) FILTER (({_RULES}) IS NOT TRUE) = 0 AND count(*) > 0 AS passed FROM rejected""")
def q_audit_rejected(spark, sf_dir):
    """The audit on rows that are to fail it (all but those whose time alone lay ahead)."""
    return audit_silver(rejected_back(spark, sf_dir), OWNER)
