"""Line dedup by content-defined chunks of lines (DataFrame functions only).

A text is cut into lines, and lines into chunks: a chunk ends after a line where
a rolling hash over the last two line hashes meets a fixed residue, so inserting
or deleting a line moves only the boundaries next to it.  Chunks of two lines or
more that hold a word and occur more than once in the corpus are duplicates; all
but the first occurrence (smallest doc_id, then place) are removed.

Steps, none of which gathers the rows of one chunk:

1. (chunk hash, place) of every multi-line chunk, without text; hashes whose
   smallest and largest place differ repeat (map-side combined);
2. bodies of the chunks with repeated hashes are grouped by hash *and body*, so
   equality is decided on the bytes; the first place of each body is kept;
3. the places to remove, listed per document, are joined to the texts.

Null text counts as empty and stays null.  Rows equal in doc_id and text count
as one document and share their result.  Null ids come first.  Columns of the
input with the names of the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import register, table
from .shared import boxed, landed, other_columns, quoted, text_digest

MODULUS = 3  # a boundary after one line in three, on average
MIN_LINES = 2


def _line_hash(line: Column) -> Column:
    """32 bits of a digest that every SQL engine has, so the boundaries can be checked elsewhere."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _held(**columns: Column) -> Column:
    """Generator of one row that holds ``columns``: evaluated once, whatever refers to them later."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def with_chunks(docs: DataFrame, text: str, modulus: int = MODULUS) -> DataFrame:
    """``docs`` plus ``__lines`` and ``__chunks``: array of (first line, number of lines)."""
    cols = docs.columns
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    a = docs.select(*cols, _held(__lines=lines))
    b = a.select(*cols, "__lines", _held(__h=F.transform("__lines", _line_hash)))
    before = F.concat(F.array(F.lit(0).cast("long")), F.col("__h"))
    cut = F.zip_with(F.col("__h"), F.slice(before, 1, F.size("__h")), lambda h, p: (h + 31 * p) % modulus == 0)
    last = F.size("__lines") - 1
    c = b.select(*cols, "__lines", _held(__cut=cut))
    marked = F.filter(F.transform("__cut", lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    ends = F.array_union(marked, F.array(last))
    d = c.select(*cols, "__lines", _held(__ends=ends))
    starts = F.concat(F.array(F.lit(0)), F.transform("__ends", lambda e: e + 1))
    chunks = F.zip_with(F.slice(starts, 1, F.size("__ends")), F.col("__ends"),
                        lambda s, e: F.struct(s.alias("first"), (e - s + 1).alias("n")))
    return d.select(*cols, "__lines", _held(__chunks=chunks))


def _body(chunk: Column) -> Column:
    return F.array_join(F.slice(F.col("__lines"), chunk["first"] + 1, chunk["n"]), "\n")


def _eligible(chunk_n: Column, body: Column) -> Column:
    return (chunk_n >= MIN_LINES) & (F.length(F.trim(F.translate(body, "\n\r\t\x0b\x0c", "     "))) > 0)


def _place() -> Column:
    return F.struct("doc_id", "__key", "__at")


def line_dedup(docs: DataFrame, text_col: str = "text", modulus: int = MODULUS) -> DataFrame:
    """``docs`` with the text that is left, n_lines, n_removed_lines and n_removed_chunks."""
    names = ["n_lines", "n_removed_lines", "n_removed_chunks"]
    own, named = other_columns(docs, *names), text_col
    keyed = docs.select(boxed([c for c in own if c != named]), "doc_id", F.col(quoted(named)).alias("__text"),
                        text_digest("doc_id", named).alias("__key"))
    text_col = "__text"
    slim = with_chunks(keyed.select("doc_id", "__key", text_col), text_col, modulus).drop(text_col)

    # 1. places by hash; a chunk of one line is never a candidate
    listed = F.filter(
        F.transform("__chunks", lambda c, i: F.struct(i.alias("at"), c["n"].alias("n"), F.xxhash64(_body(c)).alias("h"))),
        lambda c: c["n"] >= MIN_LINES)
    places = slim.select("doc_id", "__key", F.explode(listed).alias("c")).select(
        "doc_id", "__key", F.col("c.at").alias("__at"), F.col("c.h").alias("__h"))
    places = landed(places, "chunk-places")
    again = places.groupBy("__h").agg(F.min(_place()).alias("lo"), F.max(_place()).alias("hi")).filter(
        "lo <> hi").select("__h")
    again = landed(again, "chunk-hashes")  # so that the join has exchanges of its own and a frequent chunk can be split
    wanted = places.join(again, "__h", "left_semi").groupBy("__key").agg(F.collect_set("__at").alias("__wanted"))

    # 2. bodies of the candidates: grouping by the body itself compares bytes
    found = with_chunks(keyed.select("doc_id", "__key", text_col).join(wanted, "__key"), text_col, modulus)
    found = found.select("doc_id", "__key", "__lines", "__chunks", _held(__sorted=F.sort_array("__wanted")))
    bodies = F.transform("__sorted", lambda i: F.struct(
        i.alias("at"), F.get("__chunks", i)["n"].alias("n"), _body(F.get("__chunks", i)).alias("body")))
    bodies = found.select("doc_id", "__key", F.explode(bodies).alias("c")).select(
        "doc_id", "__key", F.col("c.at").alias("__at"), F.xxhash64("c.body").alias("__h"), F.col("c.body").alias("__body"),
        F.col("c.n").alias("__n")).filter(_eligible(F.col("__n"), F.col("__body"))).drop("__n")
    bodies = landed(bodies, "chunk-bodies")
    first = landed(bodies.groupBy("__h", "__body").agg(F.min(_place()).alias("__first")), "chunk-firsts")
    gone = bodies.join(first, ["__h", "__body"]).filter(_place() != F.col("__first"))
    gone = gone.groupBy("__key").agg(F.collect_set("__at").alias("__gone"))

    # 3. texts without the chunks to remove
    out = with_chunks(keyed.join(gone, "__key", "left"), text_col, modulus)
    numbers = F.sequence(F.lit(0), F.size("__chunks") - 1)
    out = out.select("__own", text_col, "__lines", "__chunks", "__gone", _held(__kept=F.array_except(numbers, F.col("__gone"))))
    rest = F.array_join(F.transform("__kept", lambda i: _body(F.get("__chunks", i))), "\n")
    removed = F.aggregate(F.coalesce("__gone", F.array().cast("array<int>")), F.lit(0).cast("long"),
                          lambda s, i: s + F.get("__chunks", i)["n"])
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(rest)
    n_gone = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")
    return out.select(
        *[text.alias(c) if c == named else F.col("__own").getField(c).alias(c) for c in own], F.size("__lines").cast("long").alias("n_lines"),
        removed.alias("n_removed_lines"), n_gone.alias("n_removed_chunks"))


ORACLE_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         len(string_split(coalesce(text, ''), chr(10))) AS n
  FROM documents),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
rolled AS (
  SELECT *, h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) AS r FROM hashed),
cuts AS (SELECT *, CASE WHEN r % {MODULUS} = 0 OR i = n THEN 1 ELSE 0 END AS cut FROM rolled),
numbered AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS chunk FROM cuts),
chunks AS (
  SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM numbered GROUP BY doc_id, chunk),
ranked AS (
  SELECT *, n >= {MIN_LINES} AND regexp_matches(body, '[^ \\n\\r\\t\\v\\f]') AS eligible,
         row_number() OVER (PARTITION BY body, n >= {MIN_LINES} ORDER BY doc_id, chunk) AS rn FROM chunks)
SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT (eligible AND rn > 1)), '') AS text,
       sum(n)::BIGINT AS n_lines,
       coalesce(sum(n) FILTER (eligible AND rn > 1), 0)::BIGINT AS n_removed_lines,
       count(*) FILTER (eligible AND rn > 1) AS n_removed_chunks
FROM ranked GROUP BY doc_id
"""


@register("op1_line_dedup", ORACLE_LINE_DEDUP)
def op1_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
