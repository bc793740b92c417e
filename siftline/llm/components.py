"""Connected components by random-mate contraction, as SQL joins.

Each round first folds leaves into their neighbours and then flips a coin per vertex from a hash of (vertex, round). Every heads vertex with a tails
neighbour is merged into the smallest such neighbour; edges are relabelled by two joins, loops and
repeats vanish, and the round's parent map is kept. When no edge is left, the maps are unwound from
last to first, so that every vertex gets the label of the vertex that absorbed it.

Each round is written to the shared folder, so that a lost executor costs one round at most, and the
driver only ever sees a count of edges. Expected rounds are logarithmic in the number of vertices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.session import materialise


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(vertex bigint, component bigint) of every vertex that has an edge.

    Null ends, self-loops and repeated edges are ignored; an empty table gives an empty result. The
    component label is some vertex of the component. Edges need not be symmetric.
    """
    e = edges.select(F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v")).where("u is not null and v is not null and u <> v")
    e = materialise(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    maps: list[DataFrame] = []
    rounds = 0
    while not e.isEmpty():
        # Leaves first: a vertex of one edge goes into its neighbour; of two leaves, the larger into the smaller.
        both = e.union(e.select("v", "u")).toDF("child", "parent")
        ends = both.groupBy("child").agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
        degree = ends.select(F.col("child").alias("parent"), F.col("n").alias("m"))
        leaves = materialise(ends.where("n = 1").join(degree, "parent").where("m > 1 or child > parent").select("child", "parent"), f"leaves{rounds}")
        gone = leaves.select(F.col("child").alias("u"))
        e = materialise(e.join(gone, "u", "left_anti").join(gone.toDF("v"), "v", "left_anti").select("u", "v"), f"core{rounds}")
        maps.append(leaves)
        if e.isEmpty():
            break

        def coin(c: str, r: int = rounds) -> Column:
            return F.xxhash64(F.col(c), F.lit(r)).bitwiseAND(1)

        both = e.union(e.select("v", "u")).toDF("child", "parent")
        parent = both.where((coin("child") == 0) & (coin("parent") == 1)).groupBy("child").agg(F.min("parent").alias("parent"))
        parent = materialise(parent, f"parents{rounds}")
        maps.append(parent)
        one = e.join(parent.toDF("u", "pu"), "u", "left").select(F.coalesce("pu", "u").alias("u"), "v")
        two = one.join(parent.toDF("v", "pv"), "v", "left").select("u", F.coalesce("pv", "v").alias("v")).where("u <> v")
        e = materialise(two.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"edges{rounds}")
        rounds += 1
    labels = edges.sparkSession.createDataFrame([], "vertex bigint, component bigint")
    for i, parent in enumerate(reversed(maps)):
        # A parent that was absorbed later has a label by now; one that was not is its own root.
        p = parent.toDF("vertex", "up").join(labels.toDF("up", "component"), "up", "left").select("vertex", "up", "component")
        fresh = p.where("component is null").select(F.col("up").alias("vertex"), F.col("up").alias("component")).distinct()
        labels = materialise(p.select("vertex", F.coalesce("component", "up").alias("component")).union(fresh).union(labels), f"labels{i}")
    return labels
