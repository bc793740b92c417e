"""Confusion, ranking and acceptance metrics as aggregates over a scored, labelled table.

Input columns are kind (T, F or U), score and, where hours count, duration_seconds. Rows with a null label or score
are left out. Curves work on one row per distinct score and on distributed running sums over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.scoring import wilson_lower
from siftline.operators.prefix import running_sums
from siftline.session import materialise


def ratio(a: Column, b: Column, empty: float | None = None) -> Column:
    """a / b; with b = 0 the given value, or a / 1."""
    return a / F.greatest(b, F.lit(1)) if empty is None else F.when(b == 0, F.lit(empty)).otherwise(a / F.greatest(b, F.lit(1)))


def threshold_aggs(drop: Column, kind: str = "kind") -> list[Column]:
    """Counts of dropped rows by label and in all."""
    k = F.col(kind)
    return [
        F.count("*").alias("n"), F.count(F.when(drop, 1)).alias("n_drop"), F.count(F.when(drop & (k == "F"), 1)).alias("f_caught"), F.count(F.when(drop & (k == "T"), 1)).alias("t_hurt"),
        F.count(F.when(drop & (k == "U"), 1)).alias("u_hurt"), F.count(F.when(k == "F", 1)).alias("n_f"), F.count(F.when(k == "T", 1)).alias("n_t"), F.count(F.when(k == "U", 1)).alias("n_u"),
    ]


def with_rates(counts: DataFrame, empty_precision: float | None = None) -> DataFrame:
    """Adds precision, f_recall, keep_rate and u_rate."""
    return (
        counts.withColumn("precision", ratio(F.col("f_caught"), F.col("n_drop"), empty_precision))
        .withColumn("f_recall", ratio(F.col("f_caught"), F.col("n_f")))
        .withColumn("keep_rate", ratio(F.col("n") - F.col("n_drop"), F.col("n")))
        .withColumn("u_rate", ratio(F.col("u_hurt"), F.col("n_u")))
    )


def threshold_metrics(df: DataFrame, threshold: float, empty_precision: float | None = None) -> DataFrame:
    """One row: what dropping below the threshold does. An empty drop set has precision 0, or `empty_precision`."""
    return with_rates(df.where("kind is not null and score is not null").agg(*threshold_aggs(F.col("score") < threshold)), empty_precision)


def _by_score(df: DataFrame, positive: Column) -> DataFrame:
    return df.where("kind is not null and score is not null").groupBy("score").agg(F.count(F.when(positive, 1)).alias("p"), F.count(F.when(~positive, 1)).alias("q"))


def roc_auc(df: DataFrame, positive: Column | None = None) -> DataFrame:
    """(auc, n_pos, n_neg) with ties at half; null where a class is empty."""
    g = running_sums(_by_score(df, F.col("kind") != "F" if positive is None else positive), [F.col("score")], {"upto": "q"})
    wins = g.withColumn("w", F.col("p") * (F.col("upto") - F.col("q") / 2))
    one = wins.agg(F.sum("w").alias("w"), F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"))
    return one.select(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("w") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"), F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("n_neg", F.lit(0)).alias("n_neg"))


def pr_curve(df: DataFrame, positive: Column | None = None) -> DataFrame:
    """(threshold, tp, n, precision, recall) per distinct score: what is at or above it."""
    g = _by_score(df, F.col("kind") != "F" if positive is None else positive)
    c = running_sums(g.withColumn("m", F.col("p") + F.col("q")), [F.desc("score")], {"tp": "p", "n": "m"})
    c = c.crossJoin(F.broadcast(c.agg(F.max("tp").alias("pos"))))  # one row
    return c.select(F.col("score").alias("threshold"), "p", "tp", "n", (F.col("tp") / F.col("n")).alias("precision"), ratio(F.col("tp"), F.col("pos")).alias("recall"), "pos")


def average_precision(df: DataFrame, positive: Column | None = None) -> DataFrame:
    c = pr_curve(df, positive)
    return c.agg(F.sum(ratio(F.col("p"), F.col("pos")) * F.col("precision")).alias("ap"))


def threshold_at_recall(df: DataFrame, targets: list[float], positive: Column | None = None) -> DataFrame:
    """(target, threshold, precision, recall): the curve point whose recall is nearest; ties to the higher threshold."""
    c = pr_curve(df, positive).select("threshold", "precision", "recall")
    t = df.sparkSession.createDataFrame([(float(x),) for x in targets], "target double")
    near = c.crossJoin(F.broadcast(t))  # a handful of targets
    return near.groupBy("target").agg(F.min(F.struct(F.abs(F.col("recall") - F.col("target")).alias("gap"), (-F.col("threshold")).alias("neg"), "threshold", "precision", "recall")).alias("r")).select("target", "r.threshold", "r.precision", "r.recall")


def action_metrics(df: DataFrame, drop_below: float, keep_from: float) -> DataFrame:
    """n, precision, hours and share of hours of the kept rows; n and overturn of the dropped ones.

    An empty keep set has precision 0 and an empty drop set overturn 1.
    """
    keep, drop, good = F.col("score") >= keep_from, F.col("score") < drop_below, F.col("kind") != "F"
    h = F.coalesce(F.col("duration_seconds"), F.lit(0.0)) / 3600
    one = df.where("kind is not null and score is not null").agg(
        F.count(F.when(keep, 1)).alias("keep_n"), F.count(F.when(keep & good, 1)).alias("keep_good"), F.sum(F.when(keep, h).otherwise(0.0)).alias("keep_hours"),
        F.sum(h).alias("hours"), F.count(F.when(drop, 1)).alias("drop_n"), F.count(F.when(drop & good, 1)).alias("drop_good"),
    )
    return one.select(
        "keep_n", ratio(F.col("keep_good"), F.col("keep_n"), 0.0).alias("keep_precision"), "keep_hours", (F.when(F.col("hours") > 0, F.col("keep_hours") / F.col("hours")).otherwise(0.0)).alias("keep_hour_share"),
        "drop_n", ratio(F.col("drop_good"), F.col("drop_n"), 1.0).alias("drop_overturn"),
    )


def direct_metrics(df: DataFrame, prediction: str, positive: Column | None = None) -> DataFrame:
    """One row on predictions T and F as such; other predictions are not valid, rows without a label take no part.

    n, valid, coverage, predicted_t and precision_t (0 where none), predicted_f and overturn_f (1 where none), accuracy (0 where none is valid).
    """
    good = (F.col("kind") != "F") if positive is None else positive
    t, f = F.coalesce(F.col(prediction) == "T", F.lit(False)), F.coalesce(F.col(prediction) == "F", F.lit(False))
    one = df.where("kind is not null").agg(
        F.count("*").alias("n"), F.count(F.when(t | f, 1)).alias("valid"), F.count(F.when(t, 1)).alias("predicted_t"), F.count(F.when(t & good, 1)).alias("_tg"),
        F.count(F.when(f, 1)).alias("predicted_f"), F.count(F.when(f & good, 1)).alias("_fg"),
    )
    right = F.col("_tg") + F.col("predicted_f") - F.col("_fg")
    return one.select(
        "n", "valid", ratio(F.col("valid"), F.col("n")).alias("coverage"), "predicted_t", ratio(F.col("_tg"), F.col("predicted_t"), 0.0).alias("precision_t"),
        "predicted_f", ratio(F.col("_fg"), F.col("predicted_f"), 1.0).alias("overturn_f"), ratio(right, F.col("valid"), 0.0).alias("accuracy"),
    )


def projection(pool: DataFrame, seconds_per_row: float, workers: int, keep_hour_share: float) -> DataFrame:
    """One row: rows and hours of a pool, hours that a step of so many seconds a row takes, and hours that stay."""
    one = pool.agg(F.count("*").alias("rows"), (F.coalesce(F.sum("duration_seconds"), F.lit(0.0)) / 3600).alias("hours"))
    return one.select("rows", "hours", (F.col("rows") * F.lit(seconds_per_row) / F.lit(max(workers, 1) * 3600.0)).alias("step_hours"), (F.col("hours") * F.lit(keep_hour_share)).alias("keep_hours"))


def status_board(df: DataFrame, status: str, by: str | None = None) -> DataFrame:
    """n_t, n_f, n_error, pending (blank) and done per group or in all; case and blanks are ignored."""
    u = F.upper(F.trim(status))
    blank = F.coalesce(u, F.lit("")) == ""
    counts = [F.count(F.when(u == k, 1)).alias(n) for k, n in (("T", "n_t"), ("F", "n_f"), ("ERROR", "n_error"))]
    return df.groupBy(*([by] if by else [])).agg(*counts, F.count(F.when(blank, 1)).alias("pending"), F.count(F.when(~blank, 1)).alias("done"))


def top_share_metrics(df: DataFrame, percents: list[float], rounding: str = "half_even", key: str = "id") -> DataFrame:
    """(percent, k, precision, recall, hours, hours_share) of the k best rows; k = n * percent / 100 rounded half to even, or cut off; 1 at least.

    The k-th score is located on counts per distinct score; rows at that score are taken in the order of the
    key, by running sums over the tied rows alone. Without duration_seconds hours are 0.
    """
    h = F.coalesce(F.col("duration_seconds").cast("double"), F.lit(0.0)) if "duration_seconds" in df.columns else F.lit(0.0)
    d = df.where("kind is not null and score is not null").select(F.col(key).alias("key"), "score", (F.col("kind") != "F").cast("int").alias("y"), h.alias("h"))
    n = d.agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.sum("h").alias("all_h"))
    t = df.sparkSession.createDataFrame([(float(p),) for p in percents], "percent double")
    raw = F.col("n") * F.col("percent") / 100
    k = F.bround(raw, 0) if rounding == "half_even" else F.floor(raw)
    want = F.broadcast(n).crossJoin(F.broadcast(t)).withColumn("k", F.greatest(F.lit(1), k.cast("bigint")))
    g = d.groupBy("score").agg(F.count("*").alias("m"), F.sum("y").alias("ys"), F.sum("h").alias("hs"))
    g = running_sums(g, [F.desc("score")], {"upto": "m", "good": "ys", "seconds": "hs"})
    hit = g.crossJoin(F.broadcast(want)).where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("m") < F.col("k")))
    hit = hit.withColumn("nth", F.col("k") - (F.col("upto") - F.col("m"))).withColumn("above", F.col("good") - F.col("ys"))
    hit = materialise(hit, "hits")  # a row per percent
    ties = d.join(F.broadcast(hit.select("percent", "score", "nth")), "score").withColumn("one", F.lit(1))
    ties = running_sums(ties, [F.col("percent"), F.col("key")], {"r": "one"})
    start = ties.groupBy("percent").agg((F.min("r") - 1).alias("start"))
    part = ties.join(F.broadcast(start), "percent").where("r - start <= nth").groupBy("percent").agg(F.sum("y").alias("tie_good"), F.sum("h").alias("tie_h"))
    out = hit.join(part, "percent").withColumn("got", F.col("above") + F.col("tie_good")).withColumn("hours", (F.col("seconds") - F.col("hs") + F.col("tie_h")) / 3600)
    share = F.when(F.col("all_h") > 0, F.col("hours") * 3600 / F.col("all_h")).otherwise(0.0)
    return out.select("percent", "k", ratio(F.col("got"), F.col("k")).alias("precision"), ratio(F.col("got"), F.col("pos")).alias("recall"), "hours", share.alias("hours_share"))


def source_weights(df: DataFrame, source: str) -> DataFrame:
    """(source, n, weight) with weight = N / (number of sources * n)."""
    g = df.groupBy(source).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))  # one row per source
    return g.select(source, "n", (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"))


def group_means(df: DataFrame, key: str, value: Column, min_rows: int = 1) -> DataFrame:
    """(key, mean, n) of keys with enough rows: the encoding of a category by its mean."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias("mean"), F.count("*").alias("n")).where(F.col("n") >= min_rows)


def acceptance(df: DataFrame, min_lower: float, min_hours: float, max_overturn: float, drop_below: float, confidence: float = 0.9) -> DataFrame:
    """One row: bound, hours and overturn of a lot, and whether all three gates hold."""
    good, drop = F.col("kind") == "T", F.col("score") < drop_below
    judged = F.col("kind").isin("T", "F")
    one = df.agg(
        F.count(F.when(judged & ~drop, 1)).alias("n"), F.count(F.when(judged & ~drop & good, 1)).alias("passed"), F.coalesce(F.sum("duration_seconds") / 3600, F.lit(0.0)).alias("hours"),
        F.count(F.when(judged & drop, 1)).alias("n_drop"), F.count(F.when(judged & drop & good, 1)).alias("overturned"),
    )
    one = one.withColumn("lower", wilson_lower("passed", "n", confidence)).withColumn("overturn", ratio(F.col("overturned"), F.col("n_drop"), 0.0))
    return one.withColumn("accepted", (F.col("lower") >= min_lower) & (F.col("hours") >= min_hours) & (F.col("overturn") <= max_overturn))


def lot_decision(lot: DataFrame, verdicts: DataFrame, min_pass: float, key: str = "video_id") -> DataFrame:
    """Point estimate of a lot from judged members; raises ValueError if a verdict is for a row outside the lot."""
    outside = verdicts.join(lot.select(key), key, "left_anti").count()
    if outside:
        raise ValueError(f"{outside} verdicts are for rows outside the lot")
    one = verdicts.agg(F.count(F.when(F.col("verdict").isin("pass", "fail"), 1)).alias("n"), F.count(F.when(F.col("verdict") == "pass", 1)).alias("passed"))
    return one.withColumn("pass_rate", ratio(F.col("passed"), F.col("n"))).withColumn("decision", F.when((F.col("n") > 0) & (F.col("pass_rate") >= min_pass), "accept").otherwise("reject"))
