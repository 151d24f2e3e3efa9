"""Connected components of a link table by repeated contraction.

Each round every node points at the neighbour with the smallest hash (itself
included); pointers are followed twice, the links are renamed to the nodes
pointed at, and links inside one node vanish. The hash changes with the round,
so long chains shrink by a constant factor too. All steps are aggregates and
joins: no link or label list reaches the driver, and a hub with very many
links is reduced by partial aggregation before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import saved

MAX_ROUNDS = 200


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` that has a partner.

    Rows with a null end and links of a node with itself say nothing and are
    left out; repeated links count once. ``root`` is one node of the component,
    not the smallest: callers take the minimum of whatever label they need.
    """
    end_a, end_b = F.col(a).cast("long"), F.col(b).cast("long")
    edges = saved(links.where(end_a != end_b)
                  .select(F.least(end_a, end_b).alias("a"), F.greatest(end_a, end_b).alias("b"))
                  .distinct())
    found = None
    for step in range(MAX_ROUNDS):
        if edges.isEmpty():
            break
        order = lambda c: F.struct(F.xxhash64(c, F.lit(step)).alias("h"), c.alias("to"))
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        up = (both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
              .select("a", F.least(F.col("m"), order(F.col("a")))["to"].alias("to")))
        up = saved(up)
        twice = up.select(F.col("a").alias("to"), F.col("to").alias("to2"))
        jump = saved(up.join(twice, "to").select("a", F.col("to2").alias("to")))
        if found is None:
            found = jump.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            nxt = jump.select(F.col("a").alias("root"), F.col("to").alias("new"))
            found = saved(found.join(nxt, "root", "left")
                          .select("node", F.coalesce("new", "root").alias("root")))
        left = jump.select("a", F.col("to").alias("x"))
        right = jump.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = saved(edges.join(left, "a").join(right, "b").where("x <> y")
                      .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                      .distinct())
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
