"""One group identifier for all records linked directly or through others.

Seed-tree pruning. In every round each vertex looks at the minimum of its
neighbourhood and tells it to all its neighbours; a vertex that is nobody's
minimum leaves the graph and hangs below the minimum it knows, as one edge of a
propagation forest. The graph shrinks from round to round; when it is empty, the
identifiers of the seeds (vertices that never left) flow down the forest.

Every round is written to the shared folder. Aggregates combine on the map side,
and the joins on a vertex put one aggregated row per vertex against its edges, so
the edges of a hub can be split over tasks (AQE skew join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace


def components(pairs: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, group_id) of every id in a pair of two different ids.

    pairs: columns ``a`` and ``b``. Null ends and self pairs link nothing; order and
    repetition of pairs do not matter. group_id is the smallest id reached. An
    empty input gives an empty result.
    """
    ends = pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    graph = workspace.materialize(
        ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph"
    )
    vertices = graph
    forest: list[DataFrame] = []
    for _ in range(max_rounds):
        # every vertex u sends min(N(u) + u) to its neighbours and to itself
        least = graph.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        told = graph.join(least, "a").select(F.col("b").alias("v"), "m").union(least.select(F.col("a").alias("v"), "m")).distinct()
        told = workspace.materialize(told, "told")
        # v knows the set H(v) of minima; its own minimum is the vertex to hang below
        best = told.groupBy("v").agg(F.min("m").alias("low"), F.max(F.col("m") == F.col("v")).alias("stays"))
        state = workspace.materialize(best, "state")
        forest.append(state.where(~F.col("stays")).select(F.col("v").alias("child"), F.col("low").alias("parent")))
        onward = told.join(state.select("v", "low"), "v").where("m <> low").select(F.col("m").alias("x"), F.col("low").alias("y"))
        edges = onward.union(onward.select("y", "x")).toDF("a", "b").distinct()
        after = workspace.materialize(edges, "graph")
        workspace.discard(told)
        if graph is not vertices:
            workspace.discard(graph)
        graph = after
        if graph.isEmpty():
            break
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    seeds = vertices.select(F.col("a").alias("id")).distinct()
    left = forest[0].select("child")
    for part in forest[1:]:
        left = left.union(part.select("child"))
    # one table per level of the forest; none is written twice
    levels = [seeds.join(left, seeds.id == left.child, "left_anti").select("id", F.col("id").alias("group_id"))]
    levels[0] = workspace.materialize(levels[0], "labels")
    # the last vertices to leave hang highest: walk the forest from the top down
    for part in reversed(forest):
        labels = reduce(DataFrame.union, levels)
        below = part.join(labels, part.parent == labels.id).select(F.col("child").alias("id"), "group_id")
        levels.append(workspace.materialize(below, "labels"))
    return reduce(DataFrame.union, levels)
