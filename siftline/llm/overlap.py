"""Problem 7: rows of evaluation splits that repeat training rows, by an exact prefix-filter join.

Title units are ordered from rare to common: counted over all titles, the `COMMON` most frequent ones come last, by
their count, all others first, by hash (any one order is exact). Two titles of similarity t
or more share a unit among the first size - ceil(t * size) + 1 of either, so only those prefixes meet:
evaluation prefixes are the index, training prefixes probe it, under a length filter and a position
filter, and what is left is verified on the full unit sets. Titles with equal unit sets and numbers are
one class per side; classes are joined and only the result is expanded to rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, present
from siftline.llm import units
from siftline.session import materialise

EVAL = ("calibration", "holdout")
COMMON = 4096  # units whose count decides their place; they go to the driver and to every task


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in units.slices(batches, "title"):
        texts = b["title"].tolist()
        h, offsets = units.unit_sets(texts)
        v = h.view(np.int32)
        out = b[["label_id", "split", "source", "video"]].copy()
        out["set_key"] = units.set_keys(h, offsets)
        out["numbers"] = units.number_keys(texts)
        out["units"] = [v[offsets[i] : offsets[i + 1]] for i in range(len(b))]
        yield out


def _reorder(common: np.ndarray):
    def reorder(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = [len(x) for x in b["units"]]
            if sum(size):
                offsets = np.concatenate(([0], np.cumsum(size)))
                h = np.concatenate(b["units"].tolist()).astype(np.int32).view(np.uint32)
                v = units.rare_first(h, offsets, common).view(np.int32)
                b = b.assign(units=[v[offsets[i] : offsets[i + 1]] for i in range(len(b))])
            yield b

    return reorder


def prefix_join(index: DataFrame, probe: DataFrame, threshold: float) -> DataFrame:
    """(index_id, probe_id) of all pairs with Jaccard similarity >= threshold and equal `numbers`.

    Both sides have id, numbers and units (distinct, not null). Empty unit sets match nothing. Exact.
    """
    t = threshold
    tagged = index.select(F.lit(0).alias("side"), "id", "numbers", "units").union(probe.select(F.lit(1), "id", "numbers", "units"))
    counts = tagged.select(F.explode("units").alias("unit")).groupBy("unit").agg(F.count("*").alias("n")).where("n > 1")
    common = [r.unit for r in counts.orderBy(F.desc("n"), "unit").limit(COMMON).collect()][::-1]
    ordered = materialise(tagged.mapInPandas(_reorder(np.array(common, np.int32)), tagged.schema), "ordered")
    size = F.size("units")
    keep = (size - F.ceil(F.lit(t) * size - F.lit(1e-9)) + 1).cast("int")
    prefixes = ordered.select("*", F.posexplode(F.slice("units", F.lit(1), keep)).alias("pos", "unit"))
    a = prefixes.where("side = 0").select("unit", "numbers", F.col("id").alias("index_id"), F.col("units").alias("ua"), F.col("pos").alias("pa"))
    b = prefixes.where("side = 1").select("unit", "numbers", F.col("id").alias("probe_id"), F.col("units").alias("ub"), F.col("pos").alias("pb"))
    n, m = F.size("ua"), F.size("ub")
    need = F.lit(t / (1 + t)) * (n + m) - F.lit(1e-9)
    met = a.join(b, ["unit", "numbers"]).where((n >= t * m - 1e-9) & (m >= t * n - 1e-9) & (F.least(n - F.col("pa"), m - F.col("pb")) >= need))
    common = F.array_intersect("ua", "ub")
    # A pair meets once per shared prefix unit; it is kept at the first unit of its overlap only.
    return met.withColumn("common", common).where((F.size("common") >= need) & (F.col("common")[0] == F.col("unit"))).select("index_id", "probe_id")


def cross_split_overlaps(labels: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(train_id, eval_id, by_video, by_title, train_source, eval_source, eval_split) of every overlap.

    A training row and a calibration or holdout row overlap if they have the same video or the same title
    (TESTDATA.md). Missing videos and titles match nothing; rows of other or null splits take no part.
    Repeated rows all come out. Extra columns are ignored. An empty table gives an empty result.
    """
    split = F.lower(F.trim("split"))
    base = labels.select(F.col("label_id").cast("bigint"), split.alias("split"), F.lower(F.trim("source")).alias("source"), bare_video_id("video_id").alias("video"), present("title").alias("title"))
    base = base.where(F.col("split").isin("train", *EVAL) & F.col("label_id").isNotNull())
    v = materialise(base.mapInPandas(_vectors, "label_id bigint, split string, source string, video string, set_key bigint, numbers bigint, units array<int>"), "titles")
    is_eval = F.col("split").isin(*EVAL)
    titled = v.where(F.size("units") > 0)
    cls = materialise(titled.groupBy("set_key", "numbers", is_eval.alias("eval")).agg(F.min("label_id").alias("id"), F.first("units").alias("units")), "classes")
    pairs = prefix_join(cls.where("eval"), cls.where("not eval"), threshold)
    key = titled.select("label_id", "set_key", "numbers", is_eval.alias("eval")).join(cls.select("set_key", "numbers", "eval", "id"), ["set_key", "numbers", "eval"])
    ev = key.where("eval").select(F.col("id").alias("index_id"), F.col("label_id").alias("eval_id"))
    tr = key.where("not eval").select(F.col("id").alias("probe_id"), F.col("label_id").alias("train_id"))
    by_title = pairs.join(ev, "index_id").join(tr, "probe_id").select("train_id", "eval_id", F.lit(True).alias("by_title"), F.lit(False).alias("by_video"))
    x = v.where("video is not null")
    same = x.where(~is_eval).select("video", F.col("label_id").alias("train_id")).join(x.where(is_eval).select("video", F.col("label_id").alias("eval_id")), "video")
    by_video = same.select("train_id", "eval_id", F.lit(False).alias("by_title"), F.lit(True).alias("by_video"))
    both = by_title.union(by_video).groupBy("train_id", "eval_id").agg(F.max("by_title").alias("by_title"), F.max("by_video").alias("by_video"))
    t_src = v.select(F.col("label_id").alias("train_id"), F.col("source").alias("train_source"))
    e_src = v.select(F.col("label_id").alias("eval_id"), F.col("source").alias("eval_source"), F.col("split").alias("eval_split"))
    return both.join(t_src, "train_id").join(e_src, "eval_id")


def overlap_pairs(labels: DataFrame) -> DataFrame:
    """(label_id_a, label_id_b), a < b, as TESTDATA.md defines the cases."""
    o = cross_split_overlaps(labels)
    return o.select(F.least("train_id", "eval_id").alias("label_id_a"), F.greatest("train_id", "eval_id").alias("label_id_b"))


def overlap_report(labels: DataFrame) -> DataFrame:
    """Overlapping evaluation rows and pairs per evaluation split and source (lower case, trimmed)."""
    return (
        cross_split_overlaps(labels)
        .groupBy("eval_split", "eval_source")
        .agg(F.countDistinct("eval_id").alias("eval_rows"), F.countDistinct("train_id").alias("train_rows"), F.count("*").alias("pairs"), F.count(F.when(F.col("by_video"), 1)).alias("pairs_by_video"), F.count(F.when(F.col("by_title"), 1)).alias("pairs_by_title"))
    )
