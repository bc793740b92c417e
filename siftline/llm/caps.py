"""Problem 2: at most `cap` rows per contributor, kept by score, as an incremental state table.

The state holds each contributor's kept rows, and beside them its cutoff: the worst kept row once `cap` are kept. A
new batch is first filtered against the stored cutoffs; rows below fall out at once. What survives is cut to the
best `cap` per (contributor, salt), so that a contributor with a third of all rows is ranked in parts of
bounded share, and then merged with the kept rows of the contributors that it touches; only these are written again. Every row that
falls out, on arrival or displaced later, is logged with the batch that pushed it out.

A batch is one version: a folder of rows by reason, a folder of cutoffs, and a mark once both are complete. A version
without its mark does not count and is written again, so a batch that fails half-way, or a new process on the same path,
goes on from the last complete version. Every `COMPACT` versions the state is written as a whole, which bounds what is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, name_key
from siftline.llm.scores import valid_scores
from siftline.session import list_names, path_exists, touch, work_path

COMPACT = 16
ROWS = "contributor string, row_id bigint, score double, batch int, v int, reason string"
CUTS = "contributor string, n bigint, cut struct<none:boolean,neg:double,row_id:bigint>, v int"


def best() -> list[Column]:
    """Best first: highest score, none last, then the smaller row_id."""
    return [F.desc_nulls_last("score"), F.asc("row_id")]


def place() -> Column:
    """The same order as a value: the smaller, the better."""
    return F.struct(F.col("score").isNull().alias("none"), F.coalesce(-F.col("score"), F.lit(0.0)).alias("neg"), F.col("row_id").alias("row_id"))


def cap_for_share(total_rows: int, share: float) -> int:
    """The count that a maximum share of a table of `total_rows` rows stands for (at least 1)."""
    return max(1, int(total_rows * share))


class CapState:
    """Kept rows per contributor, extended batch by batch.

    Rows have contributor, row_id (unique) and score. A missing contributor is not limited and not stored;
    a null score ranks last; ties go to the smaller row_id; a row that arrives again in the same batch
    counts once. Batches must not repeat earlier rows. An empty batch changes nothing. A state on a path that
    holds one goes on from its last complete version; another cap than the stored one raises ValueError.
    """

    def __init__(self, spark: SparkSession, cap: int, salts: int = 16, path: str | None = None):
        if cap < 1:
            raise ValueError("cap must be at least 1")
        self.spark, self.cap, self.salts = spark, cap, salts
        self.path = path or work_path(spark, "caps")
        stored = [int(n.removeprefix("cap=")) for n in list_names(spark, self.path) if n.startswith("cap=")]
        if stored and stored != [cap]:
            raise ValueError(f"{self.path} holds a state for cap {stored[0]}, not {cap}")
        if not stored:
            touch(spark, f"{self.path}/cap={cap}")
        self.version = max((int(n) for n in list_names(spark, f"{self.path}/done")), default=0)

    def _base(self) -> int:
        """The last version that was written as a whole; 0 for none."""
        whole = [int(n) for n in list_names(self.spark, f"{self.path}/whole") if int(n) <= self.version and path_exists(self.spark, f"{self.path}/whole/{n}/cuts/_SUCCESS")]
        return max(whole, default=0)

    def _read(self, name: str, schema: str) -> DataFrame:
        """Rows of the last whole version and of all versions after it."""
        base = self._base()
        paths = [f"{self.path}/{name}/v={v}" for v in range(base + 1, self.version + 1)]
        out = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return out.unionByName(self.spark.read.schema(schema).parquet(f"{self.path}/whole/{base}/{name}")) if base else out

    def cutoffs(self) -> DataFrame:
        """(contributor, n, cut, v): number of kept rows, place of the worst, and the version that holds them."""
        last = self._read("cuts", CUTS).groupBy("contributor").agg(F.max(F.struct("v", "n", "cut")).alias("x"))
        return last.select("contributor", "x.n", "x.cut", "x.v")

    def _kept(self, of: DataFrame) -> DataFrame:
        """Kept rows of the contributors in `of` (contributor, v)."""
        return self._read("rows", ROWS).where("reason = 'kept'").join(of.select("contributor", "v"), ["contributor", "v"], "left_semi").select("contributor", "row_id", "score")

    def kept(self) -> DataFrame:
        return self._kept(self.cutoffs())

    def log(self) -> DataFrame:
        """All rows that fell out so far: contributor, row_id, score, batch, reason."""
        if not self.version:
            return self.spark.createDataFrame([], "contributor string, row_id bigint, score double, batch int, reason string")
        paths = [f"{self.path}/rows/v={v}" for v in range(1, self.version + 1)]
        return self.spark.read.schema(ROWS).option("basePath", f"{self.path}/rows").parquet(*paths).where("reason <> 'kept'").select("contributor", "row_id", "score", "batch", "reason")

    def ingest(self, rows: DataFrame, batch: int) -> None:
        new = rows.where("contributor is not null and row_id is not null").select("contributor", F.col("row_id").cast("bigint"), F.col("score").cast("double")).dropDuplicates(["row_id"])
        v = self.version + 1
        cuts = self.cutoffs()
        met = new.join(cuts, "contributor", "left")
        below = F.coalesce((F.col("n") >= self.cap) & (place() > F.col("cut")), F.lit(False))
        out = met.where(below).select("contributor", "row_id", "score", F.lit("below cutoff").alias("reason"))
        # Rows below the cutoff are neither ranked nor merged; the others are ranked in parts first.
        part = Window.partitionBy("contributor", F.pmod(F.xxhash64("row_id"), F.lit(self.salts))).orderBy(*best())
        ranked = met.where(~below).select("contributor", "row_id", "score", "v", F.row_number().over(part).alias("r"))
        touched = ranked.where(F.col("v").isNotNull()).select("contributor", "v").distinct()
        merged = ranked.where(F.col("r") <= self.cap).select("contributor", "row_id", "score")
        if self.version:
            merged = merged.union(self._kept(touched))
        final = merged.withColumn("r", F.row_number().over(Window.partitionBy("contributor").orderBy(*best())))
        both = final.union(ranked.where(F.col("r") > self.cap).select("contributor", "row_id", "score", "r"))
        out = out.union(both.select("contributor", "row_id", "score", F.when(F.col("r") <= self.cap, F.lit("kept")).otherwise("displaced")))
        path = f"{self.path}/rows/v={v}"
        out.withColumn("batch", F.lit(batch).cast("int")).write.mode("overwrite").partitionBy("reason").parquet(path)
        kept = self.spark.read.schema(ROWS).option("basePath", f"{self.path}/rows").parquet(path).where("reason = 'kept'")
        kept.groupBy("contributor").agg(F.count("*").alias("n"), F.max(place()).alias("cut")).write.mode("overwrite").parquet(f"{self.path}/cuts/v={v}")
        touch(self.spark, f"{self.path}/done/{v}")
        self.version = v
        if v - self._base() >= COMPACT:
            self._compact()

    def _compact(self) -> None:
        whole, cuts = f"{self.path}/whole/{self.version}", self.cutoffs()
        self._kept(cuts).select("contributor", "row_id", "score", F.lit(0).alias("batch"), F.lit(self.version).alias("v"), F.lit("kept").alias("reason")).write.mode("overwrite").parquet(f"{whole}/rows")
        cuts.select("contributor", "n", "cut", F.lit(self.version).alias("v")).write.mode("overwrite").parquet(f"{whole}/cuts")


def capped_channels(candidates: DataFrame, scored: DataFrame, cap: int = 25) -> CapState:
    """The state after all batches of candidates in order (rows without a batch come last), best valid scores first."""
    spark = candidates.sparkSession
    c = candidates.select(F.col("row_id").cast("bigint").alias("row_id"), name_key("channel").alias("contributor"), bare_video_id("video_id").alias("video"), F.coalesce(F.col("batch_no").cast("int"), F.lit(2**31 - 1)).alias("batch"))
    rows = c.where("contributor is not null").join(valid_scores(scored), "video", "left").select("batch", "contributor", "row_id", "score")
    path = work_path(spark, "arrivals")
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    arrived = spark.read.schema("contributor string, row_id bigint, score double, batch int").parquet(path)
    state = CapState(spark, cap)
    for b in sorted(r.batch for r in arrived.select("batch").distinct().collect()):
        state.ingest(arrived.where(F.col("batch") == b), b)
    return state
