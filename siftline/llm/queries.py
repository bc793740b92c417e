"""Queries of the training-data operators, added to the driver's list by __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import caps, cutoffs, langid, leaks, mixing, neardup, overlap, sentences, splits
from siftline.llm.cells import CellIndex, check_batches
from siftline.llm.oracle import SQL
from siftline.session import materialise, table

Query = Callable[[SparkSession, str], DataFrame]


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates")
    return langid.stretches(c, langid.fit_on(c, F.col("lang"), ["title", "description"]))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_cases(_languages(spark, sf_dir))


def p1_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch in one language with its confidence."""
    return _languages(spark, sf_dir).select("row_id", "field_name", "stretch_start", "stretch_end", "lang", "confidence")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.capped_channels(table(spark, sf_dir, "candidates"), table(spark, sf_dir, "scored"), 25).log().select("row_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidates")
    return neardup.group_pairs(materialise(neardup.near_duplicate_groups(c, "row_id", neardup.joined_text("title", "description")), "groups"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_batches(table(spark, sf_dir, "candidates"), CellIndex(spark))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.violations(materialise(splits.related_sets(table(spark, sf_dir, "labels")), "sets"))


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per new split and source after an 80/10/10 assignment."""
    sets = materialise(splits.related_sets(table(spark, sf_dir, "labels")), "sets")
    new = splits.assign(sets, {"train": 0.8, "calibration": 0.1, "holdout": 0.1})
    return new.groupBy("new_split", "source").agg(F.count("*").alias("n"), F.count(F.when(F.col("new_split") != F.coalesce("old_split", F.lit("")), 1)).alias("moved"))


def p5_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: all rows are assigned, sets in two new splits, and whether the shares are within the largest sets' weight."""
    sets = materialise(splits.related_sets(table(spark, sf_dir, "labels")), "sets")
    goal = {"train": 0.8, "calibration": 0.1, "holdout": 0.1}
    new = materialise(splits.assign(sets, goal), "assigned")
    parted = new.groupBy("component").agg(F.countDistinct("new_split").alias("k"), F.count("*").alias("n")).agg(F.count(F.when(F.col("k") > 1, 1)).alias("parted"), F.max("n").alias("largest"), F.sum("n").alias("rows"))
    want = F.create_map(*(F.lit(x) for pair in goal.items() for x in pair))
    gaps = new.groupBy("new_split").agg(F.count("*").alias("n")).crossJoin(F.broadcast(parted)).agg(F.max(F.abs(F.col("n") - want[F.col("new_split")] * F.col("rows")) - F.col("largest")).alias("gap"))
    return parted.crossJoin(F.broadcast(gaps)).select("rows", "parted", (F.col("gap") <= 1).alias("shares_met"))  # one row each


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = cutoffs.scored_sources(table(spark, sf_dir, "labels"), table(spark, sf_dir, "scored"))
    return cutoffs.cutoffs(values, table(spark, sf_dir, "keep_targets"))[1].select("source", F.col("video").alias("video_id"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = cutoffs.scored_sources(table(spark, sf_dir, "labels"), table(spark, sf_dir, "scored"))
    return cutoffs.cutoffs(values, table(spark, sf_dir, "keep_targets"))[0]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_pairs(table(spark, sf_dir, "labels"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_report(table(spark, sf_dir, "labels"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per suite: test items, items leaked, and documents that leak."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite")
    found = p8_found(spark, sf_dir)
    return items.join(found, "item_id", "left").groupBy("suite").agg(F.countDistinct("item_id").alias("items"), F.countDistinct(F.when(F.col("doc_id").isNotNull(), F.col("item_id"))).alias("leaked_items"), F.countDistinct("doc_id").alias("documents"))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each leak stands in its document, how long it is, and how much of the item the document covers."""
    return leaks.covered(leaks.leak_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")))


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the spans over the limits of length and coverage."""
    return leaks.clean(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the mix with its copies."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares per source."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: its target, whether its cap holds, and whether its tokens are within half its longest text of the quota."""
    chosen, report = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    longest = chosen.groupBy("source").agg(F.max("tokens").alias("longest"))
    caps_ = table(spark, sf_dir, "mix_targets").select(F.lower(F.trim("source")).alias("source"), "target_pct", "max_repeats")
    r = report.join(caps_, "source").join(longest, "source", "left")
    near = F.abs(F.col("tokens") - F.col("quota")) <= F.coalesce("longest", F.lit(0)) / 2 + 1
    return r.select("source", "target_pct", (F.col("most_repeated") <= F.col("max_repeats")).alias("cap_holds"), near.alias("quota_met"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentence_units(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_stretches, p2_found, p3_found, p4_found, p5_found, p5_shares, p5_checks, p6_found, p6_report, p7_found, p7_report, p8_found, p8_report, p8_spans, p8_clean, p9_mix, p9_report, p9_checks, p10_found)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
