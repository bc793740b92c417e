"""Queries on duplicates, joins, unions, events and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id
from siftline.functions.labels import Loader
from siftline.operators import dedup, joins
from siftline.plans.catalogue import query
from siftline.plans.views import SQL_QC, qc, sql_video
from siftline.session import table, work_path
from siftline.sources import readers
from siftline.streaming import inbox


def _videos(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidates").withColumn("video", bare_video_id("video_id"))


@query("q07_dedup_keep_first", f"select row_id, video from (select row_id, {sql_video('video_id')} as video, row_number() over (partition by {sql_video('video_id')} order by row_id) as n from candidates) where n = 1")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_by_order(_videos(spark, d), ["video"], ["row_id"]).select("row_id", "video")


@query("q08_dedup_keep_last", f"select row_id, video, batch_no from (select row_id, batch_no, {sql_video('video_id')} as video, row_number() over (partition by {sql_video('video_id')} order by batch_no desc nulls last, row_id desc) as n from candidates) where n = 1")
def dedup_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_by_order(_videos(spark, d), ["video"], ["batch_no", "row_id"], last=True).select("row_id", "video", "batch_no")


@query("q08b_first_value_per_key", f"select video, min(row_id) as row_id, arg_min(coalesce(title, '∅'), row_id) as title from (select *, {sql_video('video_id')} as video from candidates) group by video")
def first_value_per_key(spark: SparkSession, d: str) -> DataFrame:
    v = _videos(spark, d).withColumn("title", F.coalesce("title", F.lit("∅")))
    return dedup.first_value_per_key(v, ["video"], "row_id", ["title"])


@query("q09b_label_loader", f"""with a as (select {sql_video('video_id')} as video_id, upper(trim(qc_result)) as k, label_id, case when split = 'train' then 0 else 1 end as o from labels where coalesce(split, '') <> 'review')
select video_id, label_kind, y, qc_round from (select video_id, k as label_kind, (k <> 'F')::int as y, case o when 0 then 'run01' else 'run02' end as qc_round, row_number() over (partition by video_id order by o, label_id) as n from a where k in ('T', 'F', 'U')) where n = 1""")
def label_loader(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels").where(F.coalesce("split", F.lit("")) != "review").withColumn("video_id", bare_video_id("video_id")).withColumn("row_ordinal", F.col("label_id"))
    first, rest = lab.where("split = 'train'"), lab.where("split <> 'train' or split is null")
    return Loader(["qc_result", "qc_text_result"]).load([("run01", first), ("run02", rest)]).select("video_id", "label_kind", "y", "qc_round")


@query("q13_one_to_one_join", f"with {SQL_QC}, f as (select video, min(id) as id from qc where video is not null group by video), c as (select {sql_video('video_id')} as video, min(row_id) as row_id from candidates group by 1) select video, id, row_id from f join c using (video)")
def one_to_one_join(spark: SparkSession, d: str) -> DataFrame:
    a = qc(spark, d).where("video is not null").groupBy("video").agg(F.min("id").alias("id"))
    b = _videos(spark, d).groupBy("video").agg(F.min("row_id").alias("row_id"))
    return joins.one_to_one(a, b, ["video"]).select("video", "id", "row_id")


@query("q14_left_lookup_default", f"with {SQL_QC}, m as (select source, avg((kind <> 'F')::int) as pass_rate from qc where kind is not null and source is not null group by source having count(*) >= 100) select id, qc.source, round(coalesce(pass_rate, 0.5), 6) as pass_rate from qc left join m on qc.source = m.source")
def left_lookup_default(spark: SparkSession, d: str) -> DataFrame:
    q = qc(spark, d)
    m = q.where("kind is not null and source is not null").groupBy("source").agg(F.avg((F.col("kind") != "F").cast("int")).alias("pass_rate"), F.count("*").alias("n")).where("n >= 100")
    return joins.lookup(q, m, "source", "pass_rate", 0.5).select("id", "source", F.round("pass_rate", 6).alias("pass_rate"))


@query("q15_semi_known_labels", f"select row_id from candidates where {sql_video('video_id')} in (select {sql_video('video_id')} from labels)")
def semi_known(spark: SparkSession, d: str) -> DataFrame:
    return joins.known(_videos(spark, d), table(spark, d, "labels").select(bare_video_id("video_id").alias("video")), "video").select("row_id")


@query("q16_anti_unlabelled", f"select row_id from candidates where {sql_video('video_id')} is null or {sql_video('video_id')} not in (select {sql_video('video_id')} from labels where {sql_video('video_id')} is not null)")
def anti_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    return joins.unknown(_videos(spark, d), table(spark, d, "labels").select(bare_video_id("video_id").alias("video")), "video").select("row_id")


@query("q17_ordered_gather", "with w(pos, vec_id) as (values (0, 17), (1, 3), (2, 999999), (3, 250), (4, 0)) select w.pos, w.vec_id::bigint as vec_id, e.label, e.vec_id is not null as found from w left join embeddings e on e.vec_id = w.vec_id")
def ordered_gather(spark: SparkSession, d: str) -> DataFrame:
    return joins.gather([17, 3, 999999, 250, 0], table(spark, d, "embeddings").select("vec_id", "label"), "vec_id")


@query("q18_enrich_label_source", "select c_custkey, coalesce(r_name, case when c_acctbal > 5000 then 'RICH' end) as region, case when r_name is not null then 'ref_join' when c_acctbal > 5000 then 'title_rule' else 'yt_only' end as label_source from customer left join (select n_nationkey, r_name from nation join region on n_regionkey = r_regionkey where r_name <> 'ASIA') r on c_nationkey = n_nationkey")
def enrich_label_source(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    ref = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    return joins.enrich(table(spark, d, "customer"), ref, "c_nationkey", "region", F.when(F.col("c_acctbal") > 5000, "RICH")).select("c_custkey", "region", "label_source")


@query("q19_union_schema_align", "select s_suppkey::bigint as id, s_name as name, s_acctbal as balance, null::varchar as segment, 'supplier' as source_name from supplier union all select c_custkey, c_name, c_acctbal, c_mktsegment, 'customer' from customer")
def union_schema_align(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return joins.union_tagged([("supplier", s), ("customer", c)])


@query("q19b_side_merge", "with s as (select label_id, qc_result as r from labels where split = 'holdout') select l.label_id, coalesce(case when trim(s.r) <> '' and lower(trim(s.r)) <> 'nan' then s.r end, l.qc_bool) as qc_bool from labels l left join s using (label_id)")
def side_merge(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels")
    side = lab.where("split = 'holdout'").select("label_id", F.col("qc_result").alias("qc_bool"))  # the side file covers one split
    return joins.side_merge(lab.select("label_id", "qc_bool"), side, "label_id", ["qc_bool"])


@query("q45_missing_embeddings", "select label_id from labels where label_id not in (select vec_id from embeddings)")
def missing_embeddings(spark: SparkSession, d: str) -> DataFrame:
    from siftline.operators.vectors import missing_ids

    return missing_ids(table(spark, d, "labels").select("label_id"), table(spark, d, "embeddings").select(F.col("vec_id").alias("label_id")), "label_id")


@query("q56_modality_conflict", f"with {SQL_QC}, a as (select video, case when contains(lower(title), 'oven') then 'kitchen' else 'other' end as t from qc where id in (select min(id) from qc where video is not null and title is not null group by video)), b as (select {sql_video('video_id')} as video, case when contains(lower(title), 'kettle') then 'kitchen' else 'other' end as t from candidates where row_id in (select min(row_id) from candidates where title is not null group by {sql_video('video_id')})) select video, a.t as a_value, b.t as b_value from a join b using (video) where a.t <> b.t")
def modality_conflict(spark: SparkSession, d: str) -> DataFrame:
    def tag(df: DataFrame, order: str, word: str) -> DataFrame:
        one = dedup.first_value_per_key(df.where("title is not null and video is not null"), ["video"], order, ["title"])
        return one.select("video", F.when(F.lower("title").contains(word), "kitchen").otherwise("other").alias("t"))

    return joins.conflicts(tag(qc(spark, d), "id", "oven"), tag(_videos(spark, d), "row_id", "kettle"), "video", "t")


@query("q65_event_error_window", "select date_trunc('hour', ts) as window_start, count(*) as n, count(*) filter (event_type = 'error') as errors, round(count(*) filter (event_type = 'error') / count(*), 6) as error_rate from events group by 1")
def event_error_window(spark: SparkSession, d: str) -> DataFrame:
    return inbox.error_windows(table(spark, d, "events"), "ts", F.col("event_type") == "error").withColumn("error_rate", F.round("error_rate", 6))


@query("q66_breaker_streak", """with e as (select *, (event_type in ('error', 'view'))::int as f from events), w as (select event_id, f, user_id, sum(f) over r as fails, count(*) over r as seen, sum(1 - f) over (partition by user_id order by ts, event_id) as ok from e window r as (partition by user_id order by ts, event_id rows between 9 preceding and current row)),
s as (select *, sum(f) over (partition by user_id, ok order by event_id rows unbounded preceding) as streak from w) select event_id, fails::bigint as fails, streak::bigint as streak, (streak >= 5 or (seen = 10 and fails >= 8)) as tripped from s""")
def breaker_streak(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return inbox.rolling_breaker(e, "user_id", ["ts", "event_id"], F.col("event_type").isin("error", "view")).select("event_id", "fails", "streak", "tripped")


@query("q66b_longest_streak", "with e as (select *, (event_type = 'error')::int as f, sum(1 - (event_type = 'error')::int) over (partition by user_id order by ts, event_id) as ok from events) select user_id, max(n)::bigint as longest from (select user_id, ok, sum(f) as n from e group by 1, 2) group by user_id")
def longest_streak(spark: SparkSession, d: str) -> DataFrame:
    return inbox.longest_streaks(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("q67_sessionise_30m", "with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from e) select user_id, min(ts) as session_start, count(*) as n from s group by user_id, k")
def sessionise(spark: SparkSession, d: str) -> DataFrame:
    return inbox.sessions(table(spark, d, "events"), "user_id", "ts")


@query("q68_csv_round_trip", "select row_id::varchar as row_id, title, description, channel from candidates")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The whole table written as CSV and read back with string types: quotes and line breaks survive."""
    path = work_path(spark, "csv")
    c = table(spark, d, "candidates").select(F.col("row_id").cast("string"), "title", "description", "channel")
    cols = ["title", "description", "channel"]
    # An empty text and a null are told apart by a mark, because CSV cannot.
    c.select("row_id", *(F.when(F.col(x).isNull(), "\\N").otherwise(F.concat(F.lit("="), x)).alias(x) for x in cols)).write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = readers.read_csv(spark, path, names=["row_id", *cols])
    return back.select("row_id", *(F.when(F.col(x) == "\\N", None).otherwise(F.substring(x, 2, 1 << 30)).alias(x) for x in cols))


def _candidate_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "candidates").schema
    if _is_folder(spark, f"{d}/candidates.parquet"):
        stream = inbox.read_inbox(spark, f"{d}/candidates.parquet", schema, "parquet")
    else:
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "candidates.parquet").parquet(d)
    return stream.withColumn("video", bare_video_id("video_id")).where("video is not null")


@query("q69_stream_first_seen", f"select distinct {sql_video('video_id')} as video from candidates where {sql_video('video_id')} is not null")
def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """The videos of the candidates, read as a stream of files, each once: duplicates within the watermark fall out. All harvest times lie within its delay."""
    out = work_path(spark, "stream")
    first = inbox.first_seen(_candidate_stream(spark, d).select("video", F.coalesce("harvested_at", F.lit("2000-01-01").cast("timestamp")).alias("t")), "video", "t", "40000 days")
    inbox.run_batches(first, lambda batch, i: batch.select("video").write.mode("append").parquet(out), work_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema("video string").parquet(out)


@query("q69b_stream_counts", f"select {sql_video('video_id')} as video, count(*) as n from candidates where {sql_video('video_id')} is not null group by 1")
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """The candidates read as a stream of files and counted per video by a stateful aggregation to its end."""
    out = work_path(spark, "stream")
    per = _candidate_stream(spark, d).groupBy("video").agg(F.count("*").alias("n"))

    def sink(batch: DataFrame, i: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    per.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", work_path(spark, "stream-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("q70_exclude_known_texts", "with b as (select distinct lower(trim(regexp_replace(passage, '\\s+', ' ', 'g'))) as t from eval_items) select doc_id from documents where text is null or lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) not in (select t from b)")
def exclude_known_texts(spark: SparkSession, d: str) -> DataFrame:
    from siftline.functions.text import squeeze

    b = table(spark, d, "eval_items").select(F.lower(squeeze("passage")).alias("t"))
    return joins.unknown(table(spark, d, "documents").withColumn("t", F.lower(squeeze("text"))), b, "t").select("doc_id")


@query("q70b_revenue_by_nation", "select n_name, o_orderpriority, count(*) as orders, round(sum(l_extendedprice * (1 - l_discount)), 4) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where l_shipdate >= timestamp '1997-01-01' group by n_name, o_orderpriority")
def revenue(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz '1997-01-01'")
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("orders"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))

