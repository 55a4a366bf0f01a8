"""Quote-aware CSV reading in byte ranges, against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from strata.sources.readers import csv_records, read_csv_dialect

HEADER = ["id", "note", "other"]


def write(path, rows, end="\r\n", last=True):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(HEADER)
    w.writerows(rows)
    text = out.getvalue()
    path.write_bytes((text if last else text.removesuffix(end)).encode())


def python_rows(paths):
    out = []
    for p in paths:
        with open(p, newline="", encoding="utf-8") as fh:
            out += [tuple(r) for r in csv.reader(fh) if r][1:]
    return sorted(out)


def got(spark, path):
    df = read_csv_dialect(spark, str(path))
    return df, sorted(map(tuple, df.collect()))


def rows_of(seed, n=120):
    rng = random.Random(seed)
    parts = ["a", "b", " ", ",", '"', "\n", "\r\n", "", "é", "12", '""', "\n\n", ";", "x" * 40]
    return [[str(k), *("".join(rng.choice(parts) for _ in range(rng.randrange(7))) for _ in range(2))] for k in range(n)]


@pytest.fixture
def chunk(spark):
    """Sets the bytes of a chunk."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}

    def use(size):
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end, last", [("\r\n", True), ("\n", True), ("\n", False)])
@pytest.mark.parametrize("size", [97, 700])
def test_equals_the_csv_module_at_many_borders(spark, tmp_path, chunk, end, last, size):
    for k in range(2):
        write(tmp_path / f"f{k}.csv", rows_of(k), end, last)
    chunk(size)
    df, rows = got(spark, tmp_path)
    assert df.columns == HEADER and rows == python_rows([tmp_path / "f0.csv", tmp_path / "f1.csv"])
    assert csv_records(spark, str(tmp_path)).count() == 242


def test_every_border_inside_a_quoted_field(spark, tmp_path, chunk):
    """The cuts move over a record with line ends byte by byte."""
    write(tmp_path / "f.csv", [["1", 'one\n"two",\n\nthree', "z"], ["2", "plain", "\n"], ["3", "", ""]], "\n")
    want = python_rows([tmp_path / "f.csv"])
    for size in range(12, 60, 6):
        chunk(size)
        assert got(spark, tmp_path)[1] == want, size


def test_a_record_over_many_chunks(spark, tmp_path, chunk):
    write(tmp_path / "f.csv", [["1", "line\n" * 500, "end"], ["2", "b", "c"]])
    chunk(128)
    assert got(spark, tmp_path)[1] == python_rows([tmp_path / "f.csv"])


def test_one_file_is_read_by_many_tasks(spark, tmp_path, chunk):
    write(tmp_path / "f.csv", rows_of(7, 400))
    chunk(1000)
    lines = csv_records(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    assert lines.filter("header").count() == 1


def test_short_long_and_blank_records(spark, tmp_path):
    (tmp_path / "f.csv").write_text('"id","no\nte",other\n\n1\n2,b,c,d\n\n"",,\n')
    df, rows = got(spark, tmp_path)
    assert df.columns == ["id", "no\nte", "other"] and rows == [("", "", ""), ("1", "", ""), ("2", "b", "c")]


def test_header_only_and_empty_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,note\n")
    df, rows = got(spark, tmp_path)
    assert df.columns == ["id", "note"] and rows == []


def test_no_python_and_pruned_groups_in_the_plan(spark, tmp_path):
    write(tmp_path / "f.csv", rows_of(1))
    plan = read_csv_dialect(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
