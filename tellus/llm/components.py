"""Connected components of an undirected graph by star contraction.

In each round every node hands its larger neighbours to its smallest one
(large star), then its smaller neighbours too (small star). The edges turn
into stars around the smallest node of each component in a number of rounds
that grows with the logarithm of its size. Nodes with very many neighbours
are reduced by a grouped minimum, which combines before the shuffle; every
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tellus.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node with a link; root is the smallest
    node of the component. Self links and nulls are left out."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(f"{a} <> {b}").distinct()
    e, last = written(e, "links"), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        last = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
