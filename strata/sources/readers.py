"""Readers for landed and written layers.

Bronze partition values are taken from the file path with ``regexp_extract`` and
``recursiveFileLookup`` turns partition discovery off: path values would silently
override same-named record fields.  Silver, whose path columns are not in its files,
is read with partition columns of fixed types.  Schemas are always explicit (no inference pass), except where
a caller asks for the notebooks' inference behaviour.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..functions.schemas import MANIFEST, MOBILITY, SILVER_WEATHER, WEATHER_ENVELOPE

BRONZE_GLOB = "*.{jsonl,txt}"  # landed JSON-lines files (ours are written by the text sink)


def file_path_col() -> F.Column:
    return F.col("_metadata.file_path")


def path_value(path_col, key: str, pattern: str = r"[^/]+") -> F.Column:
    """``key=<value>`` from a hive-style path; ``""`` when absent (regexp_extract semantics)."""
    return F.regexp_extract(path_col, f"{key}=({pattern})", 1)


def read_bronze(spark: SparkSession, root: str, schema: T.StructType = WEATHER_ENVELOPE,
                glob: str = BRONZE_GLOB, require: bool = True) -> DataFrame:
    """Landed envelope JSON lines -> rows + file_path, ingest_date, hour (strings).

    PERMISSIVE: a malformed line becomes an all-null row (and is then rejected
    by the rules) instead of failing the job.  ``require`` looks at the listing:
    a landed file without lines is found, a missing one is not."""
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
          .option("pathGlobFilter", glob).json(root))
    fp = file_path_col()
    out = df.select("*", fp.alias("file_path"),
                    path_value(fp, "ingest_date", r"[0-9\-]+").alias("ingest_date"),
                    path_value(fp, "hour", "[0-9]{2}").alias("hour"))
    if require and not df.inputFiles():
        raise FileNotFoundError(f"No bronze JSON-lines files found under {root}")
    return out


def landed_sources(spark: SparkSession, root: str, domain: str, glob: str = BRONZE_GLOB) -> list[str]:
    """Source names with landed files of a domain, from the listing."""
    names = landed_files(spark, root, glob).where(path_value(F.col("file_path"), "domain") == domain)
    return sorted(r[0] for r in names.select(path_value(F.col("file_path"), "source")).distinct().collect())


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """The ``*.meta.json`` sidecars (one pretty-printed object per file) + their path."""
    df = (spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.meta.json").json(root))
    sidecar = file_path_col()
    # The described data file lives next to its sidecar (names repeat across folders).
    return df.select("*", sidecar.alias("sidecar_path"),
                     F.concat(F.regexp_replace(sidecar, "[^/]+$", ""), F.col("stored_file")).alias("file_path"))


def landed_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Listing of landed data files (no content is read: only path/length are selected).  Spark lists no empty files."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
          .load(root))
    return df.select(F.col("path").alias("file_path"), "length",
                     F.regexp_extract("path", r"([^/]+)$", 1).alias("stored_file")).where(
        ~F.col("stored_file").endswith(".meta.json"))


def partition_root(path: str) -> str:
    """The part of a path before its first ``key=value`` folder: the root of the table it is a part of."""
    return re.split("/(?=[^/=]+=)", path.rstrip("/"), maxsplit=1)[0]


def read_silver(spark: SparkSession, path: str, fmt: str = "json",
                schema: T.StructType = SILVER_WEATHER) -> DataFrame:
    """Silver rows read back; ``silver_file`` records the file each row came from.

    ``path`` is the table or any folder of it.  Columns of the path are partition
    columns of the types that ``schema`` gives (an hour stays ``09``), so a filter on
    them prunes the folders that are read.  A row from a folder without them, or with
    an empty value, has the empty string as its date or hour."""
    reader = spark.read.schema(schema).option("basePath", partition_root(path))
    if fmt == "json":
        df = reader.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    else:
        df = reader.parquet(path)
    days = ("ingest_date", "hour")
    stored = [F.coalesce(c, F.lit("")).alias(c) if c in days else F.col(c) for c in schema.fieldNames()]
    return df.select(*stored, file_path_col().alias("silver_file"))


def read_rejected(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Rows that a silver run turned away, with the domain and source that they were found with."""
    found = [T.StructField(f"found_{c}", T.StringType()) for c in ("domain", "source")]
    df = read_silver(spark, path, fmt, T.StructType([*SILVER_WEATHER.fields, *found]))
    return df.withColumns({c: F.col(f"found_{c}") for c in ("domain", "source")}).drop("found_domain", "found_source")


def read_csv_strings(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Header CSV; all columns strings unless ``infer`` (an extra full pass)."""
    return (spark.read.option("header", True).option("inferSchema", infer)
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path))


def csv_records(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Records of CSV files whose quoted fields may hold line ends: (record, header), one file read by many tasks.

    Files are read as lines, in byte ranges.  Quotes come in pairs, so whether a
    line begins inside a field follows from the number of quotes before it: their
    parity over the lines of a chunk, and over the chunks before it, of which only
    one row each is looked at.  Lines that are a record by themselves stay as they
    are; only the others are put together, by the place of their record's first line.

    A quote that is neither around a field nor doubled inside one is an error of the
    file that this reader does not see.  Blank lines outside of fields are no records."""
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"),
                     F.monotonically_increasing_id().alias("at")))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    in_chunk = Window.partitionBy("file", "chunk").orderBy("at")
    # parity within the chunk, before the line, and after it
    lines = lines.withColumn("after", (F.sum(odd).over(in_chunk) % 2).cast("int")).withColumn("odd", odd)
    lines = lines.withColumn("before", (F.col("after") + F.col("odd")) % 2)

    # one row a chunk: its parity, and where records begin last under either parity before it
    chunks = lines.groupBy("file", "chunk").agg(
        F.min("at").alias("first"), F.max_by("after", "at").alias("parity"),
        *(F.max(F.when(F.col("before") == p, F.col("at"))).alias(f"last{p}") for p in (0, 1)))
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("inside", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int"))
    begun = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    chunks = chunks.withColumn("begun", F.last(begun, True).over(earlier)).withColumn(
        "top", F.min(F.struct("chunk", "first")).over(Window.partitionBy("file"))["first"])

    placed = lines.join(chunks.select("file", "chunk", "inside", "begun", "top"), ["file", "chunk"])
    starts = F.col("before") == F.col("inside")  # outside of a field
    ends = F.col("after") == F.col("inside")
    home = F.coalesce(F.last(F.when(starts, F.col("at")), True).over(in_chunk), F.col("begun"))
    placed = placed.withColumn("home", home).withColumn("alone", starts & ends)
    alone = placed.filter("alone").select("value", (F.col("home") == F.col("top")).alias("header"))
    # the order of lines is that of their chunks, then of the lines in them
    split = placed.filter("not alone").groupBy("file", "home").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "at", "value"))), lambda x: x["value"]), "\n").alias("value"),
        F.min("top").alias("top")).select("value", (F.col("home") == F.col("top")).alias("header"))
    record = F.regexp_replace("value", "\r$", "")
    return alone.union(split).select(record.alias("record"), "header").filter("record <> '' or header")


def read_csv_dialect(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV in the dialect of Python's csv module: quoted fields may hold
    separators, line ends and doubled quotes; an empty field is the empty string.
    A short record has empty fields, and what a long one has too much is dropped.

    A file is read by many tasks (``csv_records``).  The names are those of the
    first file's header; every file's header is left out."""
    names = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)).columns
    if not names:
        return spark.createDataFrame([], T.StructType())
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    # fields have no length limit here: a record is bounded by its file
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "mode": "PERMISSIVE", "emptyValue": ""}
    row = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    rows = csv_records(spark, path).filter(~F.col("header")).select(row.alias("r"))
    return rows.select(*(F.coalesce(F.col(f"r.c{k}"), F.lit("")).alias(n) for k, n in enumerate(names)))


def read_csv_typed(spark: SparkSession, path: str, index_cols=(), extra=()) -> DataFrame:
    """Header CSV read with the explicit 32-column snapshot schema (single pass)."""
    lead = [T.StructField(c, T.StringType()) for c in index_cols]
    types = {"bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType()}
    lead += [T.StructField(n, types[t]) for n, t in extra]
    schema = T.StructType(lead + list(MOBILITY.fields))
    return (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").csv(path))


def read_gold_metric(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A written metric (header CSV under ``p_<col>=`` folders).  With ``columns``
    the read needs no header inference, so an empty metric reads back empty."""
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.csv").csv(path))
    else:
        df = read_csv_strings(spark, path)
    fp = file_path_col()
    return df.select("*", path_value(fp, "p_ingest_date", r"[0-9\-]+").alias("p_ingest_date"),
                     fp.alias("file_path"))


def metric_file_summary(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """File count and total rows of a written metric (one aggregate, no listing loop)."""
    return read_gold_metric(spark, path, columns).agg(F.countDistinct("file_path").alias("n_files"),
                                            F.count(F.lit(1)).alias("total_rows"))
