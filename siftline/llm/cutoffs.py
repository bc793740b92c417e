"""Problem 6: a score cutoff per source that keeps a target fraction, by a distributed order statistic.

The distinct (source, video) pairs are sorted by range over all partitions by source and falling score
and written once with their partition number. Counts per partition and source, prefix-summed, say which
partition holds a source's k-th row and how far down; that row alone is read. No source is ever
gathered in one task, whatever its share, and ties across partitions are harmless because rows at the
cutoff score are kept wherever they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, present, strip
from siftline.llm.scores import valid_scores
from siftline.session import materialise


def scored_sources(labels: DataFrame, scored: DataFrame) -> DataFrame:
    """(source, video, score): distinct videos of each source (trimmed, lower case) that have a valid score."""
    pairs = labels.select(F.lower(strip(present("source"))).alias("source"), bare_video_id("video_id").alias("video")).where("source is not null and video is not null").distinct()
    return pairs.join(valid_scores(scored), "video").select("source", "video", "score")


def cutoffs(values: DataFrame, targets: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(report, kept): per source the cutoff and the kept rows; values has (source, video, score).

    report: source, n, k, cutoff, kept. k = n * keep_permille / 1000 rounded up, the cutoff is the k-th highest
    score and every row at or above it is kept. A source without scored rows, or with k = 0, has a null
    cutoff and keeps nothing; a source without a target is left out; null targets count as missing; of
    several targets of a source the largest holds. A target over 1000 keeps everything.
    """
    spark = values.sparkSession
    goal = targets.select(F.lower(strip("source")).alias("source"), F.col("keep_permille").cast("bigint").alias("permille")).where("source is not null and permille is not null").groupBy("source").agg(F.max("permille").alias("permille"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = values.join(F.broadcast(goal) if goal.limit(10_001).count() <= 10_000 else goal, "source", "left_semi")
    ranged = wanted.repartitionByRange(parts, F.col("source"), F.col("score").desc(), F.col("video"))
    ranged = materialise(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("source", "part").agg(F.count("*").alias("n"))  # at most one row per partition and source
    w = Window.partitionBy("source")
    placed = counts.withColumn("total", F.sum("n").over(w)).withColumn("before", F.sum("n").over(w.orderBy("part")) - F.col("n")).join(goal, "source")
    placed = placed.withColumn("k", F.least("total", F.ceil(F.col("total") * F.col("permille") / F.lit(1000) - F.lit(1e-9))))
    target = placed.where("k > before and k <= before + n").select("source", "part", (F.col("k") - F.col("before")).alias("nth"))
    inside = ranged.join(target, ["source", "part"])
    row = inside.withColumn("at", F.row_number().over(Window.partitionBy("source", "part").orderBy(F.desc("score"), "video"))).where("at = nth")
    cut = materialise(row.select("source", F.col("score").alias("cutoff")), "cutoffs")
    kept = ranged.join(cut, "source").where("score >= cutoff").select("source", "video", "score")
    sizes = placed.groupBy("source").agg(F.max("total").alias("n"), F.max("k").alias("k"))
    report = goal.select("source").join(sizes, "source", "left").join(cut, "source", "left").join(kept.groupBy("source").agg(F.count("*").alias("kept")), "source", "left")
    return report.select("source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).cast("bigint").alias("k"), "cutoff", F.coalesce("kept", F.lit(0)).alias("kept")), kept
