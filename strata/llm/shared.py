"""Spark helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


def landed(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back.

    The files survive lost executors, so a retry never recomputes (and never
    renumbers) what later steps refer to.  ``file_rows`` bounds the rows of a file,
    and so what a reader or writer of very wide rows holds at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def other_columns(df: DataFrame, *taken: str) -> list[str]:
    """The caller's columns without those of the names ``taken`` (results replace them), which differ by more than case."""
    gone = {c.lower() for c in taken}
    return [c for c in df.columns if c.lower() not in gone]


def boxed(names: list[str]) -> Column:
    """The caller's columns as one struct ``__own``, so that their names meet none of the operator's own."""
    if not names:
        return F.lit(None).cast("boolean").alias("__own")  # a struct without fields cannot be written
    return F.struct(*(F.col(quoted(c)) for c in names)).alias("__own")


def unboxed(names: list[str]) -> list[Column]:
    return [F.col("__own").getField(c).alias(c) for c in names]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_digest(id_col: str, text_col: str) -> Column:
    """128-bit digest of a row's id and text, the key under which results are joined back to texts.

    A null text counts as empty.  Rows equal in both have one key.
    """
    return F.md5(F.concat_ws("\x01", F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("null")),
                             F.coalesce(F.col(quoted(text_col)), F.lit(""))))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components of an undirected edge list: (node, root).

    Alternating large-star / small-star steps: every node is linked to the
    smallest neighbour, hubs are aggregated map-side (min) before any shuffle
    and no neighbour list is ever gathered.  ``root`` is the smallest node of
    the component; nodes without an edge are not returned.  Each round is
    landed in the shared folder.
    """
    kind = edges.schema[u].dataType
    links = landed(
        edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        # large star: neighbours larger than a node are linked to the node's smallest neighbour
        both = links.select(F.col("a").alias("n"), F.col("b").alias("m")).union(
            links.select(F.col("b").alias("n"), F.col("a").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("lo")).select("n", F.least("n", "lo").alias("lo"))
        large = both.join(low, "n").filter("m > n").select(F.col("m").alias("a"), F.col("lo").alias("b"))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("lo"))
        small = large.join(least, "a")
        nxt = landed(
            small.select(F.col("b").alias("a"), F.col("lo").alias("b")).filter("a <> b")
            .union(least.select("a", F.col("lo").alias("b"))).distinct(), "stars")
        # done when every larger end hangs on one root and no root hangs on another
        multi = nxt.groupBy("a").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count()
        chained = 1 if multi else nxt.join(nxt.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        links = nxt
        if not multi and not chained:
            break
    nodes = links.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))
    roots = links.select(F.col("b").cast(kind).alias("node"), F.col("b").cast(kind).alias("root")).distinct()
    return nodes.union(roots)
