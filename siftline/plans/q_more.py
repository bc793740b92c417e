"""Queries on group ids, pending rows, definitions, fills, errors, storyboards and encoders."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import keys, labels
from siftline.operators import encoders, joins, models, nested, rules
from siftline.plans import stages
from siftline.plans.catalogue import query
from siftline.plans.views import qc, sql_present, sql_video
from siftline.session import table
from siftline.sources.remote import PERMANENT, TRANSIENT


@query("q71_group_id", f"select label_id, coalesce({sql_present('channel')}, {sql_present('source_ref')}, {sql_present('video_id')}) as group_id from labels")
def group_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("label_id", keys.group_id("channel", "source_ref", "video_id").alias("group_id"))


@query("q72_pending_mask", "select label_id, coalesce(trim(qc_result), '') = '' as pending, upper(coalesce(trim(qc_result), '')) in ('', 'ERROR') as pending_with_errors from labels")
def pending_mask(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("label_id", labels.pending("qc_result").alias("pending"), labels.pending("qc_result", True).alias("pending_with_errors"))


@query("q73_filter_by_definition", f"with d as (select {sql_video('video_id')} as video, max(thumb_ok::int) = 1 as ok from scored group by 1) select label_id, l.title, coalesce(d.ok, false) as kept from labels l left join d on d.video = {sql_video('l.video_id')}")
def filter_by_definition(spark: SparkSession, d: str) -> DataFrame:
    """Label rows of videos whose score table says that the picture is good, and the others; `title` of the definition is a leftover."""
    lab = table(spark, d, "labels").select("label_id", "title", keys.bare_video_id("video_id").alias("video"), F.lit("old").alias("thumb_ok"))
    s = table(spark, d, "scored").groupBy(keys.bare_video_id("video_id").alias("video")).agg(F.max(F.col("thumb_ok").cast("int")).alias("thumb_ok"))
    kept, dropped = joins.by_definition(lab, s, "video", "thumb_ok")
    return kept.withColumn("kept", F.lit(True)).union(dropped.withColumn("kept", F.lit(False))).select("label_id", "title", "kept")


@query("q74_fill_blank", "select row_id, coalesce(nullif(trim(lang), ''), case when contains(lower(coalesce(title, '')), ' the ') then 'en' end) as lang, case when nullif(trim(lang), '') is null and contains(lower(coalesce(title, '')), ' the ') then 'title_rule' end as lang_source from candidates")
def fill_blank(spark: SparkSession, d: str) -> DataFrame:
    rule = F.when(F.lower(F.coalesce("title", F.lit(""))).contains(" the "), "en")
    return table(spark, d, "candidates").select("row_id", *labels.fill_blank("lang", rule, "title_rule", "lang_source"))


def _sql_has(parts: tuple[str, ...]) -> str:
    return " or ".join(f"contains(x, '{p}')" for p in parts)


@query("q75_error_kind", f"select event_id, case when {_sql_has(TRANSIENT)} then 'transient' when {_sql_has(PERMANENT)} then 'permanent' else 'unknown' end as kind from (select event_id, lower(case event_id % 4 when 0 then 'HTTP ' || (400 + user_id % 200) when 1 then 'Private video' when 2 then 'read timed out' else event_type end) as x from events)")
def error_kind(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("event_id") % 4
    text = F.when(m == 0, F.concat(F.lit("HTTP "), (F.col("user_id") % 200 + 400).cast("string"))).when(m == 1, "Private video").when(m == 2, "read timed out").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", labels.error_kind(text, TRANSIENT, PERMANENT).alias("kind"))


@query("q76_storyboard_urls", "select row_id, case row_id % 3 when 0 then 'sb0=' || url || ',sb2=x' when 1 then 'sb2=x' else '' end as boards from (select row_id, coalesce(trim(url), '') as url from candidates) where url <> ''")
def storyboard_urls(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").where("trim(coalesce(url, '')) <> ''")

    def board(tier: str, url: str) -> str:
        return f"named_struct('format_id', '{tier}', 'format_note', 'storyboard', 'height', cast(null as int), 'resolution', cast(null as string), 'vcodec', 'none', 'acodec', 'none', 'fragments', array(named_struct('url', cast(null as string)), named_struct('url', {url})))"

    two, sb0, blank = board("sb2", "'x'"), board("sb0", "url"), board("sb1", "' '")
    f = c.select("row_id", F.expr(f"case row_id % 3 when 0 then array({two}, {blank}, {sb0}) when 1 then array({blank}, {two}) else array({blank}) end").alias("formats"))
    urls = F.transform(nested.storyboard_urls(F.col("formats")), lambda x: F.concat(x["tier"], F.lit("="), x["url"]))
    return f.select("row_id", F.array_join(urls, ",").alias("boards"))


@query("q77_hashed_text_embeddings")
def hashed_text_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of all titles by the stand-in encoder."""
    return encoders.encode(table(spark, d, "candidates"), "row_id", "title", encoders.hashed_ngrams())


@query("q78_boosted_trees_scores")
def boosted_trees(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees on score, duration and title length; each row is scored by a model that has not seen it."""
    q = qc(spark, d).where("kind in ('T', 'F')").select("id", (F.col("kind") != "F").cast("int").alias("y"), F.coalesce("score", F.lit(-1.0)).alias("s"), F.coalesce("duration_seconds", F.lit(0.0)).alias("dur"), F.length(F.coalesce("title", F.lit(""))).cast("double").alias("len"))
    return models.out_of_fold(q, "id", "y", lambda train: models.boosted(["s", "dur", "len"], trees=10), 3)


@query("q79_reduced_vectors")
def reduced_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings on their eight principal components."""
    return models.reduce(table(spark, d, "embeddings"), "vec_id", "embedding", 8, centred=True)


@query("q79b_reduced_variance", """with f as (select vec_id, i, embedding[i]::double as x from embeddings, range(1, 65) as r(i)), m as (select i, avg(x) as c from f group by i) select count(distinct vec_id) as n, round(sum((x - c) ** 2), 3) as spread from f join m using (i)""")
def reduced_variance(spark: SparkSession, d: str) -> DataFrame:
    """All 64 principal components hold the whole spread of the vectors about their mean."""
    r = models.reduce(table(spark, d, "embeddings"), "vec_id", "embedding", 64, centred=True)
    return r.agg(F.count("*").alias("n"), F.round(F.sum(F.aggregate("reduced", F.lit(0.0), lambda a, x: a + x * x)), 3).alias("spread"))


@query("q80_ingest_verdicts", """with l as (select label_id, case when lower(trim(qc_result)) in ('t', '合格', 'pass') then 'pass' when lower(trim(qc_result)) in ('f', '不合格', 'fail') then 'fail' end as human_label from labels)
select 'labeled' as part, count(*) as n from l where human_label is not null union all select human_label, count(*) from l where human_label is not null group by 1 union all select 'train_export', count(*) from l where human_label is not null union all select 'reject_validated', count(*) from l where human_label = 'fail'""")
def ingest_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table of a round of human checks."""
    parts = stages.ingest_verdicts(table(spark, d, "labels"), "qc_result", "label_id")
    out = [df.agg(F.lit(name).alias("part"), F.count("*").alias("n")).select("part", "n") for name, df in parts.items()]
    return functools.reduce(DataFrame.union, out)


@query("q81_reflux_sample", "select row_id from candidates where contains(lower(coalesce(title, '')), 'official') order by md5('7:' || row_id), row_id limit 50")
def reflux_sample(spark: SparkSession, d: str) -> DataFrame:
    dropped = table(spark, d, "candidates").where(F.lower(F.coalesce("title", F.lit(""))).contains("official")).select("row_id", "title")
    return stages.reflux_sample(dropped, 50, 7, "row_id").select("row_id")


REGIONS = {"de": "(^| )(der|die|das) ", "fr": "(^| )(le|la|les) ", "en": "(^| )the "}
GENRES = {"workshop": "lathe|saw|welding", "kitchen": "oven|kettle|stove"}


def _classes(classes: dict[str, str]) -> str:
    return "case " + " ".join(f"when regexp_matches(x, '{p}') then '{n}'" for n, p in classes.items()) + " end"


@query("q74b_region_genre", f"select row_id, {_classes(REGIONS)} as region, {_classes(GENRES)} as genre, case when ({_classes(REGIONS)}) is not null or ({_classes(GENRES)}) is not null then 'title_rule' else '' end as src from (select row_id, lower(concat_ws(' ', coalesce(title, ''), coalesce(channel, ''))) as x from candidates)")
def region_genre(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("channel", F.lit("")))
    (region, a), (genre, b) = rules.classify(text, REGIONS), rules.classify(text, GENRES)
    return table(spark, d, "candidates").select("row_id", region.alias("region"), genre.alias("genre"), F.greatest(a, b).alias("src"))
