"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.session import staged


def _ordered(a, b) -> list:
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node with an edge to
    another one; loops, repeated edges and null ends are passed over.

    Each round replaces the edges of a node to lower ones by edges of all of them to the
    lowest, then lets every edge jump to the lowest neighbour of its lower end. Edges only
    get shorter and their number does not grow, so the rounds are about the logarithm of
    the longest path. A round is written to the shared folder; nothing but two counts
    reaches the driver. Hot nodes: the lowest neighbour is a combined aggregate, and the
    joins that bring it back can be split.
    """
    now = staged(
        edges.where(F.col(a) != F.col(b)).select(*_ordered(F.col(a), F.col(b))).distinct(), "edges"
    )
    while True:
        lowest = now.groupBy("hi").agg(F.min("lo").alias("m"))
        starred = now.join(own_exchange(lowest), "hi")
        star = staged(
            starred.select(F.inline(F.array(
                F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            ))).where("hi != lo").distinct(),
            "edges",
        )
        lowest = star.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("lo"), "m")
        jumped = star.join(own_exchange(lowest), "lo", "left")
        now = staged(
            jumped.select("hi", F.coalesce("m", "lo").alias("lo"), F.col("m").isNotNull().alias("moved")).distinct(),
            "edges",
        )
        state = now.agg(F.max(F.col("moved")).alias("moved")).first()
        now = now.select("hi", "lo").distinct()
        if not state["moved"]:
            break
    # No lower end has a lower neighbour: every node points to its smallest one.
    roots = now.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
