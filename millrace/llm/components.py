"""Connected components of a graph given as edges, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stage


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end, without loops."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return _tidy(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _tidy(moved.unionByName(least.withColumnRenamed("least", "b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the ends of the edges ``(a, b)``: the smallest node each can reach.

    Every round is written to the shared folder, so a lost executor costs one round at most. The
    number of rounds grows with the logarithm of the graph's size. Sums are taken before
    edges meet, and only narrow rows are joined.
    """
    print_of = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")]
    now = stage(_tidy(edges), "edges")
    before = now.agg(*print_of).first()
    while before["n"]:
        now = stage(_small_star(_large_star(now)), "edges")
        after = now.agg(*print_of).first()
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
