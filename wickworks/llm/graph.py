"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import written


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable from each id that has an edge in ``edges`` (a, b).

    Every round each node moves to the least of itself and its neighbours and
    the graph is drawn anew between the places moved to, until no edge is left;
    the moves are then followed from the first round to the last.  All tables
    stay distributed.  An empty table gives an empty result; loops and repeated
    edges do no harm.
    """
    graph = written(edges.where("a <> b").select("a", "b"), "cc-edges")
    moves = []
    while not graph.isEmpty():
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")), "cc-moves")
        moves.append(move)
        to_a, to_b = move.select("a", F.col("to").alias("x")), move.select(F.col("a").alias("b"), F.col("to").alias("y"))
        graph = written(graph.join(to_a, "a").join(to_b, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")), "cc-edges")
    if not moves:
        return graph.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    out = moves[0].select(F.col("a").alias("id"), F.col("to").alias("comp"))
    for move in moves[1:]:
        step = move.select(F.col("a").alias("comp"), "to")
        out = out.join(step, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    return out
