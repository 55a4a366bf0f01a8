"""Distributed sinks.  Rows never pass through the driver.

Layout: ``rebalance(*partition_cols)`` (an AQE-aware repartition) groups each
output partition's rows into few tasks, but splits a skewed partition value
(one hour holding a third of the rows) across several tasks/files and merges
tiny ones; ``maxRecordsPerFile`` caps any single file.  This replaces the
reference's hard ``repartition(8)``, which writes up to 8 small files into
every partition folder and has no answer for skew.

Text and JSON lines are written to several folders at once (``open_folders``): sorting
the lines of a task by folder would spill whole tables to disk.  Columnar files hold
a row group each in memory while they are open, so their rows are sorted by folder.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.schemas import SCHEMA_VERSION

MAX_RECORDS_PER_FILE = 5_000_000
OPEN_FILES = 256  # of one task; rows of further folders are sorted by folder
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
SILVER_PARTITIONS = ("domain", "source", "schema_v", "batch_id", "ingest_date", "hour")


def write_layout(df: DataFrame, partition_cols=()) -> DataFrame:
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


def _writer(df: DataFrame, partition_cols, mode: str):
    w = write_layout(df, partition_cols).write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    return w.partitionBy(*partition_cols) if partition_cols else w


@contextmanager
def open_folders(spark: SparkSession, files: int = OPEN_FILES):
    """While a table is written, a task keeps the files of up to ``files`` folders open and does not sort its rows by folder."""
    before = spark.conf.get(OPEN_FILES_KEY, None)
    spark.conf.set(OPEN_FILES_KEY, str(files))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OPEN_FILES_KEY)
        else:
            spark.conf.set(OPEN_FILES_KEY, before)


def versioned_path(root: str, name: str | None, batch_id: str, schema_v: int = SCHEMA_VERSION) -> str:
    base = f"{root}/{name}" if name else root
    return f"{base}/schema_v={schema_v}/batch_id={batch_id}"


def batch_folder(root: str, domain: str, source: str, batch_id: str, schema_v: int = SCHEMA_VERSION) -> str:
    """Where the silver rows of a batch and source lie."""
    return versioned_path(f"{root}/domain={domain}", f"source={source}", f"{batch_id}-{source}", schema_v)


def _on_file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def existing_folders(spark: SparkSession, folders: list[str]) -> list[str]:
    return [f for f in folders if (lambda fs, path: fs.exists(path))(*_on_file_system(spark, f))]


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in existing_folders(spark, folders):
        fs, path = _on_file_system(spark, folder)
        fs.delete(path, True)


def write_silver_parquet(df: DataFrame, path: str, partition_cols=("ingest_date", "hour")) -> str:
    (_writer(df, list(partition_cols), "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


def write_silver_jsonl(df: DataFrame, path: str, partition_cols=("ingest_date", "hour")) -> str:
    """One JSON object per line, partition columns moved to the path.  Timestamps
    are written in UTC with an explicit format (independent of the driver's zone).
    A rerun of a batch replaces the folders it writes."""
    with open_folders(df.sparkSession):
        (_writer(df, list(partition_cols), "overwrite").option("partitionOverwriteMode", "dynamic")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .option("ignoreNullFields", "false")
         .json(path))
    return path


def write_gold_csv(df: DataFrame, path: str, partition_col: str = "ingest_date") -> str:
    """Header CSV partitioned by ``p_<col>`` while ``<col>`` stays inside the file."""
    part = f"p_{partition_col}"
    _writer(df.withColumn(part, F.col(partition_col)), [part], "overwrite").option("header", True).csv(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV; quotes inside a field are doubled, as Python's csv module writes them."""
    _writer(df, [], "overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_json_rows(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def land_text(df: DataFrame, value_col: str, path: str, partition_cols) -> str:
    """Land pre-serialised lines (e.g. JSON envelopes) under hive-style folders."""
    with open_folders(df.sparkSession):
        _writer(df.select(F.col(value_col).alias("value"), *partition_cols), list(partition_cols), "append").text(path)
    return path
