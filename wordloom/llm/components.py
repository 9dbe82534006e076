"""Connected components of links between integer ids, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.session import cut


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One round: tie the larger (or the smaller) neighbours of each id to its least neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("a", "least"))
    tied = both.join(least, "a")
    if larger:
        tied = tied.filter("b > a").select("least", "b")
    else:
        # The id itself hangs on its least neighbour like the others.
        tied = tied.select("least", "b").union(least.select("least", F.col("a").alias("b")))
    tied = tied.filter("least < b")
    return tied.select(F.col("least").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every id in links (a, b); component is the least id reachable.

    A node's neighbours meet only in a minimum, which is partly taken before the shuffle, and in
    a join whose large keys adaptive execution splits. Each round is cut by a checkpoint; the
    number of rounds follows the logarithm of the longest chain.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = cut(links.filter("a < b").distinct())
    marks = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = links.agg(*marks).first()
    while before[0]:
        links = cut(_star(_star(links, True), False))
        after = links.agg(*marks).first()
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
