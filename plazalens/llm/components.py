"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import checkpointed


def _contract(edges: DataFrame, large: bool) -> DataFrame:
    """Re-hang neighbours on the smallest neighbour of each node.

    ``large``: each node's larger neighbours move to its smallest one;
    otherwise its smaller neighbours and itself do. The minimum is a
    partial aggregate and the moves are a join, so no node's neighbour list
    is ever gathered in one place.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if large:
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.filter("a <> b").distinct()


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b): every linked node ``a`` that is not its component's smallest node ``b``.

    ``edges`` has two comparable columns ``a`` and ``b``. Runs until a round
    changes nothing; each round is checkpointed in the shared folder.
    """
    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = checkpointed(edges.filter("a <> b").distinct())
    last = digest(edges)
    for _ in range(max_rounds):
        edges = checkpointed(_contract(_contract(edges, True), False))
        now = digest(edges)
        if now == last:
            return edges
        last = now
    raise RuntimeError("components did not settle")
