"""Connected components of a graph of links, as rounds of joins and grouped minima.

No step gathers the neighbours of a node: minima combine inside tasks first, and the joins read tables written
to the shared folder, so that adaptive execution can split a hot node's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import drop_written, written

MOST_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of (a, b) with the smallest node it is connected with.

    Links to itself count for nothing; repeated links count once; a node without a link is not listed.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                    .distinct(), "edges")
    for _ in range(MOST_ROUNDS):
        parents = written(edges.groupBy("hi").agg(F.min("lo").alias("p")), "parents")
        up = parents.select(F.col("hi").alias("p"), F.col("p").alias("pp"))
        # Each node's smallest neighbour is its parent, moved to that one's parent where there is one; its other
        # neighbours become neighbours of the parent. What was connected stays connected, and all numbers fall.
        jumped = parents.join(up, "p", "left").select(
            "hi", F.coalesce("pp", "p").alias("lo"), F.col("pp").isNotNull().alias("moved"))
        others = edges.join(parents, "hi").where("lo <> p").select(
            F.col("lo").alias("hi"), F.col("p").alias("lo"), F.lit(True).alias("moved"))
        before = edges
        edges = written(jumped.unionAll(others).groupBy("hi", "lo").agg(F.max("moved").alias("moved")), "edges")
        drop_written(parents, before)
        if not edges.agg(F.max("moved")).first()[0]:
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionAll(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
