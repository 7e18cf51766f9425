"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm.common import written
from cardamom.session import drop_scratch, shared_dir


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Alternating star contraction.  A round has two steps.  The first links each
    node's larger neighbours to the smallest of its neighbours and itself, the
    second its smaller neighbours.  Minima are added up in the map tasks, so a
    node with very many edges is one row per task; joining the minimum back is
    a plain inner join, where Spark can split a hot node.  Each round is
    written to the shared folder, and goes when the next one has been.
    """
    spark = edges.sparkSession
    links, place = _stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).where("u > v")
        own = least.select("u", F.col("m").alias("v"))
        before = place
        links, place = _stored(small.unionByName(own).distinct())
        drop_scratch(spark, before)
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("h")).first()
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    found = written(links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
    drop_scratch(spark, place)
    return found


def _stored(links: DataFrame) -> tuple[DataFrame, str]:
    place = shared_dir(links.sparkSession, "edges")
    links.write.parquet(place)
    return links.sparkSession.read.schema(links.schema).parquet(place), place
