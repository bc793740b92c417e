"""Problem 5: train, calibration and holdout splits that keep related rows together.

A row belongs to its group (the first present of label_group, channel, source_ref, as a name) and to its
video. Only videos that occur in several groups tie groups together, so the graph that is contracted
(random mates, components.py) has groups as vertices and one star per such video, never a pair per two
rows. Components are then placed on the line of cumulative weight: heavy ones first, the others in hash
order, each in the split that holds its middle. Prefix sums are taken per hash bucket and then over the
buckets, so no task sees all components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, name_key
from siftline.llm.components import connected_components
from siftline.session import materialise

SPLITS = ("train", "calibration", "holdout")
BUCKETS = 1024


def related_sets(labels: DataFrame) -> DataFrame:
    """(label_id, split, source, component) of every row.

    Rows without any name and video are sets of their own. Names and videos are compared as
    TESTDATA.md says. Repeated rows share a set; an empty table gives an empty result.
    """
    group = F.coalesce(name_key("label_group"), name_key("channel"), name_key("source_ref"))
    rows = labels.where("label_id is not null").select(
        F.col("label_id").cast("bigint").alias("label_id"), F.lower(F.trim("split")).alias("split"), F.lower(F.trim("source")).alias("source"),
        F.when(group.isNotNull(), F.xxhash64(F.lit("group"), group)).alias("g"),
        F.when(bare_video_id("video_id").isNotNull(), F.xxhash64(F.lit("video"), bare_video_id("video_id"))).alias("v"),
    )
    rows = materialise(rows, "rows")
    tied = rows.where("g is not null and v is not null").select("g", "v").distinct()
    first = materialise(tied.groupBy("v").agg(F.min("g").alias("g0"), F.max("g").alias("g1")), "videos")
    edges = tied.join(first.where("g0 <> g1"), "v").where("g <> g0").select("g", "g0")
    comp = connected_components(edges, "g", "g0")
    at = rows.join(first.select("v", "g0"), "v", "left").withColumn("anchor", F.coalesce("g", "g0", "v", F.xxhash64(F.lit("row"), F.col("label_id"))))
    return at.join(comp.toDF("anchor", "component"), "anchor", "left").select("label_id", "split", "source", F.coalesce("component", "anchor").alias("component"))


def violations(sets: DataFrame) -> DataFrame:
    """(label_id): rows of the three splits whose set has rows in more than one of them."""
    used = sets.where(F.col("split").isin(*SPLITS))
    bad = used.groupBy("component").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select("component")
    return used.join(bad, "component", "left_semi").select("label_id")


def assign(sets: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(label_id, component, old_split, new_split): whole components, shares of the rows as near as their sizes allow."""
    if not shares or min(shares.values()) < 0 or sum(shares.values()) <= 0:
        raise ValueError("shares must not be negative and must have a positive sum")
    total_share = sum(shares.values())
    comp = materialise(sets.groupBy("component").agg(F.count("*").alias("weight")), "weights")
    total = comp.agg(F.sum("weight")).first()[0] or 0
    heavy = F.col("weight") > 0.25 * total * min(s for s in shares.values() if s > 0) / total_share
    h = F.xxhash64("component", F.lit(5))
    placed = comp.withColumn("bucket", F.when(heavy, F.lit(0)).otherwise(1 + F.pmod(h, F.lit(BUCKETS - 1))).cast("int")).withColumn("rank", F.when(heavy, -F.col("weight")).otherwise(h))
    sizes = placed.groupBy("bucket").agg(F.sum("weight").alias("w"))  # BUCKETS rows at most
    starts = sizes.select("bucket", (F.sum("w").over(Window.orderBy("bucket")) - F.col("w")).alias("start"))
    inner = F.sum("weight").over(Window.partitionBy("bucket").orderBy("rank", "component")) - F.col("weight") / 2
    placed = placed.withColumn("inner", inner).join(F.broadcast(starts), "bucket")
    where = (F.col("start") + F.col("inner")) / F.lit(max(total, 1))
    bound, split = 0.0, F.lit(None).cast("string")
    names = list(shares)
    case = None
    for name in names[:-1]:
        bound += shares[name] / total_share
        case = F.when(where < bound, name) if case is None else case.when(where < bound, name)
    split = case.otherwise(names[-1]) if case is not None else F.lit(names[-1])
    new = placed.select("component", split.alias("new_split"))
    return sets.join(new, "component").select("label_id", "component", F.col("split").alias("old_split"), "new_split", "source")
