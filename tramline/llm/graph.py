"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import staged


def _with_least(links: DataFrame, salts: int) -> DataFrame:
    """u, v, m for each link (u, v): m is the smallest of u's v.

    A node's links are dealt by (u, a hash of v), so that a node with very many has them in up to `salts` tasks;
    by the node alone go only the minima of these parts.
    """
    dealt = links.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
    parts = dealt.groupBy("u", "s").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("s").alias("in"))
    return dealt.join(least.select("u", "m", F.explode("in").alias("s")), ["u", "s"]).select("u", "v", "m")


def components(edges: DataFrame, most_rounds: int = 60, salts: int = 256) -> DataFrame:
    """node, component (its smallest node) for each node of the edges (a, b); loops and repeats do no harm.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of its neighbourhood,
    until nothing changes; rounds grow with the logarithm of a component's length. Each round is written to
    the shared folder, so that a lost executor never costs more than one. Nothing is gathered in one task or the driver.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = F.least("m", "u")
        large = _with_least(both, salts).where("v > u").select(F.col("v").alias("u"), least.alias("v")).where("u <> v").distinct()
        small = _with_least(large, salts)
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = staged(small.distinct())
        seen = now.agg(F.count("*"), F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
