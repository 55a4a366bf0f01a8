"""Whole JSON documents as VARIANT payloads."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.schemas import envelope
from strata.plans.bronze_queries import read_documents
from strata.sinks.writers import land_text
from strata.sources.bronze import document_envelope, document_field, envelope_json, partition_columns
from strata.sources.readers import read_bronze

FETCHED = "2026-04-21T09:41:16Z"
DOCS = [
    {"version": 0.6, "osm3s": {"copyright": "a \"quoted\" text", "ts": None}, "elements": [
        {"type": "way", "id": 1, "nodes": [1, 2, 3], "tags": {"highway": "primary", "name:uk": "вулиця"}},
        {"type": "node", "id": 2, "lat": 50.45, "lon": -30.5, "deep": {"a": {"b": {"c": [True, False, None, {}]}}}}]},
    {"generator": "other shape", "elements": []},
    [1, "two", {"three": 3}], "only text", 12, 1.5e300, None, {}, {"": {"": ""}},
    {"big": 12345678901234567890123, "long": 2**62, "many": [{"k%d" % i: i} for i in range(2000)]},
]


def landed(spark, tmp_path, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "raw string")
    env = document_envelope(docs, "raw", FETCHED, "osm", "o")
    lines = env.select(envelope_json().alias("value"), "domain", "source", *partition_columns(F.col("ingest_ts")))
    return land_text(lines, "value", str(tmp_path / "docs"), ["domain", "source", "ingest_date", "hour"])


def test_documents_come_back_equal(spark, tmp_path):
    """Fields that no schema names, nested ones and odd roots among them."""
    root = landed(spark, tmp_path, [json.dumps(d, indent=k % 3 or None) for k, d in enumerate(DOCS)])
    rows = read_bronze(spark, root, envelope(T.VariantType())).collect()
    said = lambda d: json.dumps(d, sort_keys=True)
    got = sorted(said(None if r.payload is None else json.loads(r.payload.toJson())) for r in rows)
    assert got == sorted(map(said, DOCS))
    assert {(r.domain, r.source, r.metadata.author_surname, r.ingest_date, r.hour) for r in rows} == {
        ("roads", "osm", "o", "2026-04-21", "09")}


def test_text_that_is_no_json_gives_a_null_payload(spark, tmp_path):
    root = landed(spark, tmp_path, ["{broken", "", None, '{"a": 1} trailing', '{"a": 1}'])
    got = [r.payload for r in read_bronze(spark, root, envelope(T.VariantType())).collect()]
    assert sorted(str(None if p is None else p.toPython()) for p in got) == ["None"] * 3 + ["{'a': 1}"] * 2


def test_fields_by_path(spark, tmp_path):
    d = read_bronze(spark, landed(spark, tmp_path, [json.dumps(DOCS[0])]), envelope(T.VariantType()))
    p = F.col("payload")
    row = d.select(document_field(p, "$.osm3s.copyright", "string").alias("a"), document_field(p, "$.version", "double").alias("b"),
                   document_field(p, "$.elements[1].deep.a.b.c[0]", "boolean").alias("c"), document_field(p, "$.none.x", "int").alias("d"),
                   document_field(p, "$.osm3s", "int").alias("e"),
                   document_field(p, "$.elements[0].tags", "map<string, string>").alias("f")).first()
    assert tuple(row) == ('a "quoted" text', 0.6, True, None, None, DOCS[0]["elements"][0]["tags"])


def test_pretty_printed_files_are_one_document_each(spark, tmp_path):
    folder = tmp_path / "domain=roads/source=osm/ingest_date=2026-04-21/hour=09"
    folder.mkdir(parents=True)
    for k, d in enumerate(DOCS[:2]):
        (folder / f"part-{k}Z.json").write_text(json.dumps({"domain": "roads", "payload": d}, indent=2), encoding="utf-8")
    got = [json.loads(r.payload.toJson()) for r in read_documents(spark, str(tmp_path)).collect()]
    assert sorted(got, key=len) == sorted(DOCS[:2], key=len)
