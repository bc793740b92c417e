"""Threshold sweeps and pickers: one aggregation over the data serves all thresholds of a grid.

Scores are first counted per (threshold bucket, label): a row falls into the first grid point above its score, and the
counts below a threshold are running sums over the buckets. The data are read once and never joined with the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.operators.metrics import ratio, with_rates


def grid(first: int, last: int) -> list[float]:
    """Hundredths, both ends included."""
    return [round(i * 0.01, 2) for i in range(first, last + 1)]


def sweep(df: DataFrame, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates of dropping below each threshold, per group; rows without label or score are left out."""
    ts = sorted(thresholds)
    points = F.array(*(F.lit(float(t)) for t in ts))
    first = F.size(F.filter(points, lambda t: t <= F.col("score")))  # the bucket: thresholds above it drop the row
    d = df.where("kind is not null and score is not null").withColumn("b", first)
    counts = d.groupBy(*by, "b").agg(F.count("*").alias("m"), *(F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("F", "T", "U")))
    total = counts.groupBy(*by).agg(F.sum("m").alias("n"), F.sum("F").alias("n_f"), F.sum("T").alias("n_t"), F.sum("U").alias("n_u"))
    steps = df.sparkSession.createDataFrame([(i, float(t)) for i, t in enumerate(ts)], "b int, threshold double")
    full = total.crossJoin(F.broadcast(steps)).join(counts, [*by, "b"], "left")  # groups times grid points
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy("b")
    run = [F.sum(F.coalesce(c, F.lit(0))).over(w).alias(name) for c, name in (("m", "n_drop"), ("F", "f_caught"), ("T", "t_hurt"), ("U", "u_hurt"))]
    return with_rates(full.select(*by, "threshold", "n", *run, "n_f", "n_t", "n_u"))


@dataclass(frozen=True)
class Picker:
    """Constraints on a sweep, what to maximise (first column first), and the threshold where nothing qualifies."""

    thresholds: Sequence[float]
    min_drop: int
    maximise: Sequence[str]
    fallback: float | None = None
    min_precision: float = 0.0
    max_t_hurt: int | None = None
    max_u_rate: float | None = None
    min_keep_rate: float = 0.0

    def allowed(self) -> Column:
        ok = (F.col("n_drop") >= self.min_drop) & (F.col("precision") >= self.min_precision) & (F.col("keep_rate") >= self.min_keep_rate)
        if self.max_t_hurt is not None:
            ok &= F.col("t_hurt") <= self.max_t_hurt
        if self.max_u_rate is not None:
            ok &= F.col("u_rate") <= self.max_u_rate
        return ok

    def pick(self, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row per group: the best threshold, ties to the smallest, or the fallback with met = false."""
        s = sweep(df, self.thresholds, by)
        order = [F.desc("ok"), *(F.desc(F.when(F.col("ok"), F.col(c))) for c in self.maximise), F.asc("threshold")]
        best = s.withColumn("ok", self.allowed()).withColumn("r", F.row_number().over(Window.partitionBy(*(by or [F.lit(1)])).orderBy(*order))).where("r = 1")
        t = F.when(F.col("ok"), F.col("threshold")).otherwise(F.lit(self.fallback).cast("double"))
        return best.select(*by, t.alias("threshold"), F.col("ok").alias("met"), *(F.when(F.col("ok"), F.col(c)).alias(c) for c in ("n_drop", "f_caught", "t_hurt", "precision", "f_recall", "keep_rate")))


# Grids and constraints of the named pickers.
STRICT = Picker(grid(1, 60), 3, ("f_caught", "precision"), None, 0.95, 0, 0.01)
STRICT_WIDE = Picker(grid(5, 60), 5, ("f_caught", "precision"), 0.35, 0.95, 0, 0.05)
STRICT_90 = Picker(grid(5, 60), 5, ("f_caught", "precision"), 0.25, 0.90, 0, 0.05)
VETO = Picker(grid(5, 94), 5, ("f_recall", "n_drop", "precision"), 0.35, 0.0, None, None, 0.08)
CONSERVATIVE = Picker(grid(1, 50), 5, ("f_caught", "precision"), 0.03, 0.95, 0)
# Fixed values: (precision, positives hurt) pairs tried in order, and the fallback, of the three profiles.
PROFILES = {"strict": (((0.90, 0), (0.80, 0)), 0.10), "mid": (((0.80, 1), (0.70, 1)), 0.15), "loose": (((0.70, 2), (0.60, 3)), 0.20)}


def profiles(df: DataFrame) -> DataFrame:
    """(profile, threshold, met): strict, mid and loose drop thresholds on the grid 0.05 to 0.54.

    strict prefers fewer positives hurt, then precision, then the higher threshold; the others prefer recall, then
    precision, then the lower threshold. Precision of an empty drop set is 1.
    """
    s = sweep(df, grid(5, 54)).withColumn("precision", ratio(F.col("f_caught"), F.col("n_drop"), 1.0))
    spark = df.sparkSession
    tries = [(name, i, p, h, back) for name, (pairs, back) in PROFILES.items() for i, (p, h) in enumerate(pairs)]
    c = spark.createDataFrame(tries, "profile string, attempt int, min_precision double, max_hurt int, back double")
    x = s.crossJoin(F.broadcast(c)).withColumn("ok", (F.col("precision") + 1e-9 >= F.col("min_precision")) & (F.col("t_hurt") + F.col("u_hurt") <= F.col("max_hurt")))  # 50 rows times 6
    strict = F.col("profile") == "strict"
    hurt = F.col("t_hurt") + F.col("u_hurt")
    keys = [F.desc("ok"), F.asc("attempt"), F.desc(F.when(strict, -hurt).otherwise(F.col("f_recall"))), F.desc("precision"), F.desc(F.when(strict, F.col("threshold")).otherwise(-F.col("threshold")))]
    best = x.withColumn("r", F.row_number().over(Window.partitionBy("profile").orderBy(*keys))).where("r = 1")
    return best.select("profile", F.when(F.col("ok"), F.col("threshold")).otherwise(F.col("back")).alias("threshold"), F.col("ok").alias("met"))


def keep_threshold(df: DataFrame, min_precision: float = 0.95, min_n: int = 10, fallback: float = 0.85) -> DataFrame:
    """(threshold, met): the smallest of 0.55 to 0.95 from which enough rows are good."""
    s = sweep(df, grid(55, 95)).withColumn("kept", F.col("n") - F.col("n_drop")).withColumn("good", F.col("n_t") + F.col("n_u") - F.col("t_hurt") - F.col("u_hurt"))
    ok = s.where((ratio(F.col("good"), F.col("kept")) >= min_precision) & (F.col("kept") >= min_n)).agg(F.min("threshold").alias("t"))
    return ok.select(F.coalesce("t", F.lit(fallback)).alias("threshold"), F.col("t").isNotNull().alias("met"))


def action_thresholds(df: DataFrame, target_pass: float, max_overturn: float, min_keep: int, min_drop: int, by: Sequence[str] = ()) -> DataFrame:
    """Per group: the smallest keep threshold that reaches target_pass and the largest drop threshold within max_overturn.

    Where no threshold meets the target, the nearest one is given with met = false (best effort): the one of
    highest precision, or lowest overturn, among those with enough rows.
    """
    s = sweep(df, grid(1, 99), by).withColumn("kept", F.col("n") - F.col("n_drop"))
    good = F.col("n_t") + F.col("n_u")
    s = s.withColumn("keep_precision", ratio(good - F.col("t_hurt") - F.col("u_hurt"), F.col("kept"))).withColumn("overturn", ratio(F.col("t_hurt") + F.col("u_hurt"), F.col("n_drop"), 1.0))
    part = list(by) or [F.lit(1)]

    def first(rows: DataFrame, ok: Column, worse: Column, t: Column, names: tuple[str, str]) -> DataFrame:
        r = rows.withColumn("ok", ok).withColumn("r", F.row_number().over(Window.partitionBy(*part).orderBy(F.desc("ok"), F.asc(F.when(F.col("ok"), F.lit(0.0)).otherwise(worse)), t))).where("r = 1")
        return r.select(*by, F.col("threshold").alias(names[0]), F.col("ok").alias(names[1]))

    keep = first(s.where(F.col("kept") >= min_keep), F.col("keep_precision") >= target_pass, -F.col("keep_precision"), F.asc("threshold"), ("keep_threshold", "keep_met"))
    drop = first(s.where(F.col("n_drop") >= min_drop), F.col("overturn") <= max_overturn, F.col("overturn"), F.desc("threshold"), ("drop_threshold", "drop_met"))
    return keep.join(drop, list(by), "full") if by else keep.crossJoin(drop)
