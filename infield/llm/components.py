"""Connected components of a graph in Spark, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from infield.llm.common import cut


def components(edges: DataFrame, rows: int | None = None, most_rounds: int = 40) -> DataFrame:
    """(node, root): the least node of the component of each node of ``edges`` (a, b); self-links and repeats do no harm.

    Each round costs two aggregations and joins over the links; the lineage is cut after each round. In the end all
    links point from a node to the root. ``rows`` is about how many links there are, if that is known.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut(links, rows)
    for _ in range(most_rounds):
        # Large star: each node's larger neighbours are linked to the least of its neighbours and itself.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: each node and its smaller neighbours are linked to the least of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        links = cut(small.where("a != b").distinct(), rows)
        # Stars are left when no node has two links and none that is linked to has a link itself.
        ends = links.groupBy("a").agg(F.count("*").alias("n"))
        rows, most = ends.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
        if (most or 0) <= 1 and links.select(F.col("b").alias("a")).join(ends, "a", "left_semi").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
    raise RuntimeError("components did not settle")
