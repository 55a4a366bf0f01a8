"""Files by name: blobs landed as they are, and ``<file>.meta.json`` beside each landed file.

Spark's own file sinks choose file names; a Python data source does not have to.
Each task writes the files of its records and puts each in place by a rename, so a
file is whole or absent.  Its name and content follow from the record alone: a
task that runs again, or a copy of it that runs beside, replaces files by equal ones.
Nothing about single files goes through the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.schemas import MANIFEST_FIELDS

SUFFIX = ".meta.json"


def file_system(path: str):
    """The file system of a path and the path in it, for any scheme that pyarrow knows (``s3a`` is its ``s3``)."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")


BLOCK = 8 << 20
REACHED = ("", "file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")  # schemes that pyarrow reads; others only Spark does
BOM = b"\xef\xbb\xbf"


@contextmanager
def placed(path: str):
    """A stream whose bytes are the file ``path`` once all are written: put in place by a rename."""
    system, name = file_system(path)
    folder, _, last = name.rpartition("/")
    part = f"{folder}/.{last}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(part) as out:
            yield out
        system.move(part, name)
    except BaseException:
        try:
            system.delete_file(part)
        except OSError:
            pass  # it was never made
        raise


def blocks(path: str):
    """The bytes of a file, a block at a time."""
    system, name = file_system(path)
    with system.open_input_stream(name) as f:
        while block := f.read(BLOCK):
            yield block


def digest_of(path: str) -> tuple[int, str]:
    md5, length = hashlib.md5(), 0
    for block in blocks(path):
        md5.update(block)
        length += len(block)
    return length, md5.hexdigest()


def copy(source, target: str) -> tuple[int, str]:
    """Length and MD5 of the bytes copied, of a file or of given blocks; no more than a block is held."""
    system, name = file_system(target)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    md5, length = hashlib.md5(), 0
    with placed(target) as out:
        for block in blocks(source) if isinstance(source, str) else source:
            md5.update(block)
            out.write(block)
            length += len(block)
    return length, md5.hexdigest()


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows over as many tasks as a shuffle has: they are short, but each stands for a file."""
    conf = rows.sparkSession.conf
    return rows.repartition(max(int(conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism), key)


def split_name(path: str) -> str:
    """The folder of a file's splits: a name that any path has of its own."""
    return hashlib.md5(path.encode()).hexdigest()


def land_splits(spark, root: str, folder: str, done: str) -> None:
    """The bytes of the files under ``root`` by Spark's reader, a file for each of their splits, in a folder of each file.

    Spark reads a file as lines, in byte ranges; a line is its bytes, whatever they are,
    and belongs to the split in which it begins.  So the splits of a file, in their
    order and every line closed, are the file, but for a line end added at its end and a
    byte order mark left out at its begin; the size in the names of the splits tells.
    Files of no more than that mark, which have no line, are read whole."""
    def run(batches):
        at, out, place = None, None, None
        try:
            for batch in batches:
                values, keys = batch.column("value"), list(zip(*(batch.column(c).to_pylist() for c in ("file", "start", "size"))))
                lo = 0
                while lo < len(keys):
                    hi = lo + 1
                    while hi < len(keys) and keys[hi] == keys[lo]:
                        hi += 1
                    if keys[lo] != at:
                        if place:
                            place.__exit__(None, None, None)
                            place = None
                        at = keys[lo]
                        path = f"{folder}/{split_name(at[0])}/{at[1]:020d}-{at[2]}"
                        system, name = file_system(path)
                        system.create_dir(name.rpartition("/")[0], recursive=True)
                        place = placed(path)
                        out = place.__enter__()
                        yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string())], ["file"])
                    out.write(b"\n".join(values.slice(lo, hi - lo).to_pylist()) + b"\n")
                    lo = hi
        except BaseException as e:
            if place:
                failed, place = place, None
                failed.__exit__(type(e), e, e.__traceback__)
            raise
        if place:
            place.__exit__(None, None, None)

    m, reader = F.col("_metadata"), spark.read.option("recursiveFileLookup", True)
    lines = reader.option("lineSep", "\n").text(root).select(
        F.col("value").cast("binary").alias("value"), m["file_path"].alias("file"), m["file_block_start"].alias("start"), m["file_size"].alias("size"))
    small = reader.format("binaryFile").load(root).filter(F.col("length") <= len(BOM)).select(
        F.col("content").alias("value"), F.col("path").alias("file"), F.lit(0).cast("bigint").alias("start"), F.col("length").alias("size"))
    lines.filter(F.col("size") > len(BOM)).union(small).mapInArrow(run, "file string").write.parquet(done)


def joined(folder: str, source: str):
    """The bytes of a file from its splits, a block at a time."""
    from pyarrow import fs

    system, name = file_system(f"{folder}/{split_name(source)}")
    splits = sorted((f for f in system.get_file_info(fs.FileSelector(name)) if f.base_name[:1].isdigit()), key=lambda f: f.base_name)
    size = int(splits[0].base_name.partition("-")[2])
    more = sum(f.size for f in splits) - size
    if more not in (0, 1, -3, -2):  # -3: the byte order mark
        raise OSError(f"{source} has {size} bytes, and {size + more} were read as lines")
    if more < 0:
        yield BOM
        more += 3
    left = sum(f.size for f in splits) - more
    for f in splits:
        with system.open_input_stream(f.path) as part:
            while block := part.read(min(BLOCK, left)):
                yield block
                left -= len(block)


def land_files(listing: DataFrame, log: str, root: str | None = None) -> DataFrame:
    """Files copied byte by byte, whatever their length: (file_path, target) -> these, length, content_md5, unchanged.

    ``content_md5`` is the digest of the bytes read; ``unchanged`` says that the landed
    file, read again, has the same length and digest.  A file is copied by one task, a
    block at a time.  Files in a store that only Spark reads must lie under ``root`` (a
    path that Spark reads): their bytes are first landed beside ``log`` by its reader, in many tasks a file.
    The result is landed under ``log``, so reading it copies nothing.
    Repeated rows are one file; two files with one target, or a missing path, are an error."""
    spark, folder = listing.sparkSession, f"{log}-splits"

    def scheme_of(path):
        scheme, colon, _ = path.partition(":")
        return scheme if colon and "/" not in scheme else ""

    def run(batches):
        for batch in batches:
            got = []
            for source, target in zip(batch.column("file_path").to_pylist(), batch.column("target").to_pylist()):
                was = copy(source if scheme_of(source) in REACHED else joined(folder, source), target)
                got.append((source, target, *was, was == digest_of(target)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)] if got else [pa.array([], t) for t in types], names)

    schemes = listing.select(F.regexp_extract("file_path", "^([^/:]*):", 1).alias("s")).distinct().collect()
    if unknown := sorted(r["s"] for r in schemes if r["s"] is not None and r["s"] not in REACHED):
        if root is None:
            raise ValueError(f"files of {unknown} are read by Spark alone: give the root they lie under")
        land_splits(spark, root, folder, f"{folder}-log")
    names, types = ["file_path", "target", "length", "content_md5", "unchanged"], [pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
    bad = F.col("target").isNull() | (F.col("n") != 1)  # a null path is not counted
    one = spread(listing.select("file_path", "target"), "target").groupBy("target").agg(
        F.min("file_path").alias("file_path"), F.count_distinct("file_path").alias("n"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not one file for the target "), F.coalesce("target", F.lit("null"))))).otherwise(F.col("target"))
    schema = "file_path string, target string, length bigint, content_md5 string, unchanged boolean"
    one.select("file_path", checked.alias("target")).mapInArrow(run, schema).write.parquet(log)
    return spark.read.schema(schema).parquet(log)


class SidecarWriter(DataSourceArrowWriter):
    def write(self, iterator):
        for batch in iterator:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with placed(path) as out:
                    out.write(content.encode())
        return WriterCommitMessage()


class Sidecars(DataSource):
    """Rows (path, content) -> files."""

    @classmethod
    def name(cls):
        return "sidecars"

    def writer(self, schema, overwrite):
        return SidecarWriter()


def write_sidecar_files(records: DataFrame) -> None:
    """A sidecar beside the file of each record (``file_path`` and the fields of a manifest).

    Of several records of one file one is written: the first in the order of their text.
    A record without a path has no place and is an error; so is a folder that is not there."""
    spark = records.sparkSession
    spark.dataSource.register(Sidecars)
    path = F.when(F.col("file_path").isNull(), F.raise_error(F.lit("a sidecar record has no file_path"))).otherwise(F.col("file_path"))
    content = F.concat(F.to_json(F.struct(*MANIFEST_FIELDS), {"pretty": "true", "ignoreNullFields": "false"}), F.lit("\n"))
    rows = records.select(F.concat(path, F.lit(SUFFIX)).alias("path"), content.alias("content"))
    spread(rows, "path").groupBy("path").agg(F.min("content").alias("content")).write.format("sidecars").mode("append").save()
