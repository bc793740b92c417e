"""Views that the catalogue's queries share, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id, present, strip
from siftline.functions.labels import kind
from siftline.functions.text import number
from siftline.operators.scores import valid_scores
from siftline.session import table

SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_present(c: str) -> str:
    return f"(case when {sql_strip(c)} <> '' and lower({sql_strip(c)}) <> 'nan' then {c} end)"


def sql_video(c: str) -> str:
    return f"nullif(regexp_replace({sql_strip(sql_present(c))}, '^.*(?:/v/|watch\\?v=)', ''), '')"


def sql_squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


KIND = "case when upper(trim(qc_result)) in ('T', 'F', 'U') then upper(trim(qc_result)) when lower(trim(qc_result)) in ('合格', 'pass') then 'T' when lower(trim(qc_result)) in ('不合格', 'fail') then 'F' end"

SQL_SCORES = f"""scores as (select video, arg_max(score, k) as score from (
  select {sql_video("video_id")} as video, ml_score as score, row(scored_at, ml_score) as k from scored
  where ml_score >= 0 and ml_score <= 1 and not isnan(ml_score) and scored_at is not null) where video is not null group by video)"""

SQL_QC = f"""{SQL_SCORES}, durations as (select {sql_video("video_id")} as video, max(nullif(try_cast(duration_seconds as double), 'nan'::double)) as duration_seconds from candidates group by 1),
qc as (select label_id as id, video, {KIND} as kind, score, lower({sql_strip(sql_present("source"))}) as source, duration_seconds, title
  from (select *, {sql_video("video_id")} as video from labels) l left join scores using (video) left join durations using (video)),
judged as (select * from qc where kind is not null and score is not null)"""


def qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, video, kind, score, source, duration_seconds, title of every label row."""
    lab = table(spark, sf_dir, "labels").select(F.col("label_id").alias("id"), bare_video_id("video_id").alias("video"), kind("qc_result").alias("kind"), F.lower(strip(present("source"))).alias("source"), "title")
    dur = table(spark, sf_dir, "candidates").groupBy(bare_video_id("video_id").alias("video")).agg(F.max(number("duration_seconds")).alias("duration_seconds"))
    return lab.join(valid_scores(table(spark, sf_dir, "scored")), "video", "left").join(dur, "video", "left")
