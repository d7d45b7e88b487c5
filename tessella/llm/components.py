"""Connected components of a table of links, without collecting links or groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import checkpointed


def least_reachable(links: DataFrame) -> DataFrame:
    """links (a, b) -> (doc_id, component) for every node that has a link: the least node that it can reach.

    Every round each node hands its neighbours the least of them (they hang on to it), and then takes its
    label's label. Stars, which the joins here make, need two rounds; a path needs a logarithm of its length.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    links = checkpointed(links)
    while True:
        # a node's larger neighbours hang on to the least of its neighbours and itself
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = links.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        # a node and its smaller neighbours hang on to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        after = checkpointed(small.filter("a != b").distinct())
        settled = after.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty() and after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        links = after
        if settled:
            break
    roots = links.select(F.col("b").alias("doc_id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("doc_id"), F.col("b").alias("component")).union(roots)
