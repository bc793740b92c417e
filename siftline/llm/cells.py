"""Problem 4: new batches against all history, with persisted inverted-file vector cells.

A title is the indicator vector of its units. A cell is centred on a coordinate axis (one unit; titles of other numbers lie in other
cells of the axis) and keeps the full vectors filed there. Axes are ordered from rare to common: the `AXES` most frequent units of
a bounded sample of `SAMPLE` titles come last, by frequency, all others first, by hash. The order is
fitted once per index and persisted; it steers cost only, the result is exact under any order.

A query probes its cells in that order. A vector not met in the first i cells shares at most |q| - i
units with the query, so its similarity is at most (|q| - i) / |q|; once that is below the threshold no
unmet vector can be near enough and probing ends. By the same bound a vector is filed under its first
axes only. Met vectors are reranked on the full vectors. (Cells around k-means centroids were
considered: at the angle that similarity 0.6 allows, 41 degrees, the triangle inequality excludes next
to no cell of such sparse vectors, so an exact probe would read nearly all; the README has the figures.)

Cells are a table bucketed by cell. A batch is filed under a new step, each bucket of it meets the same bucket of the
history in one task, without moving the history, and the step counts once its mark is written. A batch of few titles reads
only the buckets in which their cells lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, present
from siftline.llm import units
from siftline.session import list_names, materialise, path_exists, touch, work_path

SAMPLE, AXES, BUCKETS = 20_000, 4096, 16
FEW_TITLES = 200  # titles of a batch up to which only the buckets of its cells are read
VECTOR = "row_id bigint, batch_no int, video string, set_key bigint, numbers bigint, units array<int>"
CELLS = "cell bigint, axis int, pos int, numbers bigint, set_key bigint, batch_no int, first_row_id bigint, units array<int>, step int"
VIDEOS = "video string, batch_no int, first_row_id bigint, step int"
FOUND = "first_row_id bigint, row_id bigint"


def _unit_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in units.slices(batches, "title"):
        h, _ = units.unit_sets(b["title"].tolist())
        yield pd.DataFrame({"unit": h.view(np.int32)})


def fit_axes(titles: DataFrame) -> np.ndarray:
    """The most frequent units of at most SAMPLE titles, rarest of them first."""
    sample = titles.where("title is not null").orderBy(F.xxhash64("row_id"), "row_id").limit(SAMPLE).select("title")
    top = sample.mapInPandas(_unit_rows, "unit int").groupBy("unit").count().where("count > 3").orderBy(F.desc("count"), "unit").limit(AXES)
    return np.array([r.unit for r in top.collect()][::-1], np.int32)


def _vectors(axes: np.ndarray):
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in units.slices(batches, "title"):
            texts = b["title"].tolist()
            h, offsets = units.unit_sets(texts)
            v = units.rare_first(h, offsets, axes).view(np.int32)
            out = b[["row_id", "batch_no", "video"]].copy()
            out["set_key"] = units.set_keys(h, offsets)
            out["numbers"] = units.number_keys(texts)
            out["units"] = [v[offsets[i] : offsets[i + 1]] for i in range(len(b))]
            yield out

    return vectors


class CellIndex:
    """A persisted index of titles and video ids, extended batch by batch.

    Input rows have row_id (unique), batch_no, video_id, title; further columns are ignored, whatever
    their names. Rows without a title (null, blank, `nan`, or no unit in it) match by video only, rows
    without a video by title only, rows with a null row_id or batch_no not at all.

    Axes, threshold and number of buckets lie beside the cells; an index on a path that has them takes axes and buckets over and
    needs the same threshold. Cells without axes raise a ValueError: their order is lost. Steps that were begun
    but not completed do not count.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, threshold: float = 0.6, buckets: int | None = None):
        self.spark, self.path, self.threshold = spark, path or work_path(spark, "cells"), threshold
        self.buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.axes = self._stored_axes() if path else None

    def _stored_axes(self) -> np.ndarray | None:
        if not path_exists(self.spark, f"{self.path}/axes/_SUCCESS"):
            if path_exists(self.spark, f"{self.path}/cells"):
                raise ValueError(f"{self.path} holds cells but not the axes they are filed by")
            return None
        row = self.spark.read.parquet(f"{self.path}/axes").first()
        if row.threshold != self.threshold:
            raise ValueError(f"{self.path} is filed for threshold {row.threshold}, not {self.threshold}")
        self.buckets = row.buckets
        return np.array(row.axes, np.int32)

    def _store_axes(self) -> None:
        row = [(float(self.threshold), self.buckets, self.axes.tolist())]
        self.spark.createDataFrame(row, "threshold double, buckets int, axes array<int>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/axes")

    def _name(self, name: str) -> str:
        return f"siftline_{name}_{hashlib.md5(self.path.encode()).hexdigest()}"

    def _table(self, name: str, schema: str, key: str) -> str:
        """Makes one of the bucketed tables known to the session; returns its name."""
        at = self._name(name)
        self.spark.sql(f"create table if not exists {at} ({schema}) using parquet clustered by ({key}) into {self.buckets} buckets location '{self.path}/{name}'")
        return at

    def _cells(self) -> str:
        return self._table("cells", CELLS, "cell")

    def _videos(self) -> str:
        return self._table("videos", VIDEOS, "video")

    def _steps(self, name: str) -> set[int]:
        return {int(n) for n in list_names(self.spark, f"{self.path}/{name}")}

    def _complete(self) -> Column:
        """Whether a stored row belongs to a completed step."""
        failed = self._steps("begun") - self._steps("done")
        return ~F.col("step").isin(*failed) if failed else F.lit(True)

    def vectors(self, rows: DataFrame) -> DataFrame:
        """The rows with their vectors; fits and stores the axes on the first call for a new path."""
        base = rows.where("row_id is not null and batch_no is not null").select(
            F.col("row_id").cast("bigint"), F.col("batch_no").cast("int"), bare_video_id("video_id").alias("video"), present("title").alias("title")
        )
        if self.axes is None:
            self.axes = self._stored_axes()  # another index may have begun the path since
        if self.axes is None:
            self.axes = fit_axes(base)
            self._store_axes()
        return base.mapInPandas(_vectors(self.axes), VECTOR)

    def _postings(self, v: DataFrame) -> DataFrame:
        """Each distinct title of a batch, with its smallest row_id, in every cell that has to be filed or probed:
        those of its first floor((1 - threshold) * size) + 1 axes."""
        title = v.groupBy("set_key", "numbers", "batch_no").agg(F.min("row_id").alias("first_row_id"), F.first("units").alias("units"))
        n = F.size("units")
        keep = (n - F.ceil(F.lit(self.threshold) * n - F.lit(1e-9)) + 1).cast("int")
        flat = title.where(n > 0).select("*", F.posexplode(F.slice("units", F.lit(1), keep)).alias("pos", "axis"))
        return flat.select(F.xxhash64("axis", "numbers").alias("cell"), "axis", "pos", "numbers", "set_key", "batch_no", "first_row_id", "units")

    def _file(self, vectors: DataFrame) -> int:
        """Files the rows under a new step, which does not count yet."""
        step = max(self._steps("begun"), default=0) + 1
        touch(self.spark, f"{self.path}/begun/{step}")
        v = vectors.where("video is not null").groupBy("video", "batch_no").agg(F.min("row_id").alias("first_row_id"))
        parts = [(self._postings(vectors), "cell", self._cells()), (v, "video", self._videos())]
        with ThreadPoolExecutor(2) as pool:  # both are small jobs of many tasks
            list(pool.map(lambda p: p[0].withColumn("step", F.lit(step)).repartition(self.buckets, p[1]).write.insertInto(p[2]), parts))
        return step

    def append(self, vectors: DataFrame) -> None:
        """Adds rows to the history."""
        touch(self.spark, f"{self.path}/done/{self._file(vectors)}")

    def check(self, vectors: DataFrame) -> DataFrame:
        """(first_row_id, row_id): the rows of a batch that repeat the history, which is then extended by the batch.

        The batch is probed from the cells in which it is filed, bucket by bucket, and counts only when its
        result is written (to `found` beside the cells), so that a batch that failed can be checked again.
        """
        step = self._file(vectors)
        mine, older = F.col("step") == step, self._complete() & (F.col("step") < step)
        cells, videos = self.spark.table(self._cells()), self.spark.table(self._videos())
        found = self.spark.createDataFrame([], FOUND)
        if self._steps("done"):
            found = self._met(vectors, cells.where(mine), cells.where(older), videos.where(mine), videos.where(older))
        found.write.mode("overwrite").parquet(f"{self.path}/found/step={step}")
        touch(self.spark, f"{self.path}/done/{step}")
        return self.spark.read.schema(FOUND).parquet(f"{self.path}/found/step={step}")

    def close(self) -> None:
        """Takes the tables out of the session's catalogue; their files stay, and the index can be used on."""
        for name in ("cells", "videos"):
            self.spark.sql(f"drop table if exists {self._name(name)}")

    def found(self) -> DataFrame:
        """The results of all checks so far."""
        paths = [f"{self.path}/found/step={s}" for s in sorted(self._steps("done")) if path_exists(self.spark, f"{self.path}/found/step={s}")]
        return self.spark.read.schema(FOUND).option("basePath", f"{self.path}/found").parquet(*paths).select("first_row_id", "row_id") if paths else self.spark.createDataFrame([], FOUND)

    def probe(self, vectors: DataFrame) -> DataFrame:
        """(first_row_id, row_id): rows that repeat a row of a smaller batch_no by video or title, with the smallest such
        row_id. The history stays as it is."""
        cells, videos = self.spark.table(self._cells()).where(self._complete()), self.spark.table(self._videos()).where(self._complete())
        own = vectors.where("video is not null").select("video", "batch_no").distinct()
        return self._met(vectors, self._postings(vectors).repartition(self.buckets, "cell"), cells, own.repartition(self.buckets, "video"), videos)

    def _met(self, vectors: DataFrame, q: DataFrame, cells: DataFrame, qv: DataFrame, videos: DataFrame) -> DataFrame:
        if vectors.limit(FEW_TITLES + 1).count() <= FEW_TITLES:
            few = [r[0] for r in q.select("cell").distinct().collect()]
            cells = cells.where(F.col("cell").isin(*few)) if few else cells.limit(0)
        c = cells.select("cell", F.col("axis").alias("c_axis"), F.col("numbers").alias("c_numbers"), F.col("pos").alias("c_pos"), F.col("batch_no").alias("c_batch"), F.col("first_row_id").alias("by_title"), F.col("units").alias("c_units"))
        t = self.threshold
        n, m = F.size("units"), F.size("c_units")
        need = F.lit(t / (1 + t)) * (n + m) - F.lit(1e-9)
        # Equality of axes and numbers is no key of the join: both sides lie in buckets of the cell alone and stay where they are.
        same = (F.col("axis").bitwiseXOR(F.col("c_axis")) == 0) & (F.col("numbers").bitwiseXOR(F.col("c_numbers")) == 0)
        met = q.select("cell", "axis", "numbers", "pos", "batch_no", "set_key", "units").hint("shuffle_hash").join(c, "cell").where(
            same & (F.col("c_batch") < F.col("batch_no"))
            & (n >= t * m - 1e-9) & (m >= t * n - 1e-9) & (F.least(n - F.col("pos"), m - F.col("c_pos")) >= need)
        )
        # A pair meets in every cell that both probe and file; it counts in the first axis of its overlap.
        near = met.withColumn("common", F.array_intersect("units", "c_units")).where((F.size("common") >= need) & (F.col("common")[0] == F.col("axis")))
        by_title = near.groupBy("set_key", "numbers", "batch_no").agg(F.min("by_title").alias("by_title"))
        v = videos.select("video", F.col("batch_no").alias("v_batch"), F.col("first_row_id").alias("by_video"))
        by_video = qv.select("video", "batch_no").hint("shuffle_hash").join(v, "video").where("v_batch < batch_no").groupBy("video", "batch_no").agg(F.min("by_video").alias("by_video"))
        keys = vectors.select("row_id", "batch_no", "video", "set_key", "numbers")
        found = keys.join(by_title, ["set_key", "numbers", "batch_no"], "left").join(by_video, ["video", "batch_no"], "left")
        return found.where("by_title is not null or by_video is not null").select(F.least("by_title", "by_video").alias("first_row_id"), "row_id")


def check_batches(candidates: DataFrame, index: CellIndex) -> DataFrame:
    """(first_row_id, row_id): the batches of a table checked and filed one after another, in the order of batch_no."""
    vectors = materialise(index.vectors(candidates), "vectors", ["batch_no"])
    for b in sorted(r.batch_no for r in vectors.select("batch_no").distinct().collect()):
        index.check(vectors.where(F.col("batch_no") == b))
    index.close()
    return index.found()
