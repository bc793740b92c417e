"""Running sums and order statistics over a global order, without a task that sees all rows.

Rows are sorted by range and written once with their partition; sums per partition are summed up before it,
and only within a partition does a window run. The number of partitions bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.session import materialise


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Adds, for each new name, the sum of a column over all rows up to and with this one. The order must be total."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(*(F.sum(c).alias(f"_t_{n}") for n, c in sums.items()))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), "_part")
    return out.select(*df.columns, *((F.sum(c).over(inside) + F.col(f"_o_{n}")).alias(n) for n, c in sums.items()))


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """(p, value) exact quantiles with linear interpolation; null values are left out; no row for an empty table."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("m"))
    upto = running_sums(counts, [F.col("x")], {"upto": "m"})
    n = upto.agg(F.max("upto").alias("n"))
    p = df.sparkSession.createDataFrame([(float(q),) for q in probabilities], "p double")
    want = F.broadcast(n.crossJoin(p)).where("n > 0").withColumn("at", F.col("p") * (F.col("n") - 1))  # a row per probability
    hit = upto.crossJoin(F.broadcast(want)).where(((F.col("upto") > F.floor("at")) & (F.col("upto") - F.col("m") <= F.floor("at"))) | ((F.col("upto") > F.ceil("at")) & (F.col("upto") - F.col("m") <= F.ceil("at"))))
    ends = hit.groupBy("p", "at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return ends.select("p", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))).alias("value"))
