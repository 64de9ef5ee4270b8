"""Connected components of links, as joins and groupings only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in links (a, b): the smallest id reachable.

    Alternates two steps until nothing changes: every node hands its smallest neighbour
    to its larger ones, then to its smaller ones (large-star and small-star). Rounds
    grow with the logarithm of the longest path. A node's neighbours are never brought
    together: only their minimum, a combined aggregate, is joined back to the links.
    """
    pairs = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        pairs = stored(small.where("a <> b").distinct())
        # Equal sums of both ends and of their hashes: the links did not change.
        mark = pairs.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
        before = mark
    stars = pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
