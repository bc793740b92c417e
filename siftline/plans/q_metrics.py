"""Queries on metrics, thresholds, samples, lots and rejection metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import scoring
from siftline.functions.keys import bare_video_id, group_id
from siftline.functions.labels import kind
from siftline.operators import metrics, models, sampling, tags, thresholds
from siftline.plans.catalogue import query
from siftline.plans.views import KIND, SQL_QC, qc, sql_present, sql_video
from siftline.session import table

Z90 = 1.6448536269514722


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return qc(spark, d).where("kind is not null and score is not null")


def _r(df: DataFrame, *columns: str) -> DataFrame:
    """Rounded to six places for comparison."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _rates(where: str = "score < threshold") -> str:
    return f"""count(*)::bigint as n, count(*) filter ({where})::bigint as n_drop, count(*) filter ({where} and kind = 'F')::bigint as f_caught, count(*) filter ({where} and kind = 'T')::bigint as t_hurt, count(*) filter ({where} and kind = 'U')::bigint as u_hurt,
  count(*) filter (kind = 'F')::bigint as n_f, count(*) filter (kind = 'T')::bigint as n_t, count(*) filter (kind = 'U')::bigint as n_u"""


RATES = "f_caught / greatest(n_drop, 1) as precision, f_caught / greatest(n_f, 1) as f_recall, (n - n_drop) / greatest(n, 1) as keep_rate, u_hurt / greatest(n_u, 1) as u_rate"


def _sweep_sql(first: int, last: int, by: str = "") -> str:
    b = by + ", " if by else ""
    return f"sweep as (select *, {RATES} from (select {b}threshold, {_rates()} from judged, (select round(i * 0.01, 2)::double as threshold from range({first}, {last + 1}) as r(i)) group by {b}threshold))"


@query("q21_source_target_encoding", f"with {SQL_QC} select source, round(avg((kind <> 'F')::int), 6) as mean, count(*) as n from judged where source is not null group by source having count(*) >= 5")
def target_encoding(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.group_means(_judged(spark, d), "source", (F.col("kind") != "F").cast("int"), 5), "mean")


@query("q22_threshold_metrics", f"with {SQL_QC} select n, n_drop, f_caught, t_hurt, u_hurt, n_f, n_t, n_u, round(f_caught / greatest(n_drop, 1), 6) as precision, round(f_caught / greatest(n_f, 1), 6) as f_recall, round((n - n_drop) / greatest(n, 1), 6) as keep_rate, round(u_hurt / greatest(n_u, 1), 6) as u_rate from (select {_rates('score < 0.3')} from judged)")
def threshold_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.threshold_metrics(_judged(spark, d), 0.3), "precision", "f_recall", "keep_rate", "u_rate")


@query("q23_threshold_sweep", f"with {SQL_QC}, {_sweep_sql(5, 60)} select threshold, n, n_drop, f_caught, t_hurt, u_hurt, n_f, n_t, n_u, round(precision, 6) as precision, round(f_recall, 6) as f_recall, round(keep_rate, 6) as keep_rate, round(u_rate, 6) as u_rate from sweep")
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return _r(thresholds.sweep(_judged(spark, d), thresholds.grid(5, 60)), "precision", "f_recall", "keep_rate", "u_rate")


def _pick_sql(first: int, last: int, ok: str, keys: str, fallback: str) -> str:
    return f"""with {SQL_QC}, {_sweep_sql(first, last)}, best as (select * from sweep where {ok} order by {keys}, threshold limit 1)
select coalesce(threshold, {fallback})::double as threshold, (threshold is not null) as met, n_drop, f_caught, t_hurt, round(precision, 6) as precision, round(f_recall, 6) as f_recall, round(keep_rate, 6) as keep_rate from (select 1) left join best on true"""


for _name, _picker, _ok in (
    ("q24_pick_strict", thresholds.STRICT, "n_drop >= 3 and precision >= 0.95 and t_hurt <= 0 and u_rate <= 0.01"),
    ("q24b_pick_strict_wide", thresholds.STRICT_WIDE, "n_drop >= 5 and precision >= 0.95 and t_hurt <= 0 and u_rate <= 0.05"),
    ("q24c_pick_strict_90", thresholds.STRICT_90, "n_drop >= 5 and precision >= 0.9 and t_hurt <= 0 and u_rate <= 0.05"),
    ("q25_pick_veto", thresholds.VETO, "n_drop >= 5 and keep_rate >= 0.08"),
    ("q26_pick_conservative", thresholds.CONSERVATIVE, "n_drop >= 5 and precision >= 0.95 and t_hurt <= 0"),
):

    def _picked(spark: SparkSession, d: str, _picker: thresholds.Picker = _picker) -> DataFrame:
        return _r(_picker.pick(_judged(spark, d)), "precision", "f_recall", "keep_rate")

    _first, _last = round(_picker.thresholds[0] * 100), round(_picker.thresholds[-1] * 100)
    query(_name, _pick_sql(_first, _last, _ok, ", ".join(f"{c} desc" for c in _picker.maximise), "null" if _picker.fallback is None else str(_picker.fallback)))(_picked)


@query("q27_three_profiles", f"""with {SQL_QC}, {_sweep_sql(5, 54)}, s as (select *, case when n_drop = 0 then 1.0 else precision end as p, t_hurt + u_hurt as hurt from sweep),
c(profile, attempt, mp, mh, back) as (values ('strict', 0, 0.90, 0, 0.10), ('strict', 1, 0.80, 0, 0.10), ('mid', 0, 0.80, 1, 0.15), ('mid', 1, 0.70, 1, 0.15), ('loose', 0, 0.70, 2, 0.20), ('loose', 1, 0.60, 3, 0.20)),
x as (select *, (p + 1e-9 >= mp and hurt <= mh) as ok from s, c),
r as (select *, row_number() over (partition by profile order by ok desc, attempt, case when profile = 'strict' then -hurt else f_recall end desc, p desc, case when profile = 'strict' then threshold else -threshold end desc) as place from x)
select profile, (case when ok then threshold else back end)::double as threshold, ok as met from r where place = 1""")
def three_profiles(spark: SparkSession, d: str) -> DataFrame:
    return thresholds.profiles(_judged(spark, d))


@query("q27b_keep_threshold", f"""with {SQL_QC}, t as (select round(i * 0.01, 2)::double as threshold from range(55, 96) as r(i)),
k as (select threshold, count(*) filter (score >= threshold) as kept, count(*) filter (score >= threshold and kind <> 'F') as good from judged, t group by threshold)
select coalesce(min(threshold), 0.85)::double as threshold, min(threshold) is not null as met from k where good / greatest(kept, 1) >= 0.8 and kept >= 10""")
def keep_threshold(spark: SparkSession, d: str) -> DataFrame:
    return thresholds.keep_threshold(_judged(spark, d), 0.8)


@query("q28_roc_auc", f"""with {SQL_QC}, r as (select (kind <> 'F')::int as y, avg(rn) over (partition by score) as mid from (select *, row_number() over (order by score) as rn from judged))
select round((sum(mid) filter (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) as auc, sum(y)::bigint as n_pos, (count(*) - sum(y))::bigint as n_neg from r""")
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.roc_auc(_judged(spark, d)), "auc")


CURVE = "g as (select score, sum((kind <> 'F')::int) as p, count(*) as m from judged group by score), curve as (select score, p, sum(p) over (order by score desc) as tp, sum(m) over (order by score desc) as n, (select sum(p) from g) as pos from g)"


@query("q29_average_precision", f"with {SQL_QC}, {CURVE} select round(sum(p / pos * tp / n), 6) as ap from curve")
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.average_precision(_judged(spark, d)), "ap")


@query("q30_precision_at_recall", f"""with {SQL_QC}, {CURVE}, t(target) as (values (0.5), (0.8), (0.95)), r as (select target::double as target, score as threshold, tp / n as precision, tp / pos as recall, row_number() over (partition by target order by abs(tp / pos - target), score desc) as k from curve, t)
select target, threshold, round(precision, 6) as precision, round(recall, 6) as recall from r where k = 1""")
def precision_at_recall(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.threshold_at_recall(_judged(spark, d), [0.5, 0.8, 0.95]), "precision", "recall")


def _top_sql(k: str) -> str:
    return f"""with {SQL_QC}, t(percent) as (values (1.0), (5.0), (12.5), (40.0)), r as (select (kind <> 'F')::int as y, coalesce(duration_seconds, 0) as h, row_number() over (order by score desc, id) as rn, count(*) over () as n from judged),
q as (select percent, y, h, rn, greatest(1, {k}) as k from r, t) select percent::double as percent, any_value(k)::bigint as k, round(sum(y) filter (rn <= k) / any_value(k), 6) as precision, round(sum(y) filter (rn <= k) / sum(y), 6) as recall,
  round(sum(h) filter (rn <= k) / 3600, 4) as hours, round(sum(h) filter (rn <= k) / sum(h), 6) as hours_share from q group by percent"""


def _top(df: DataFrame) -> DataFrame:
    return _r(df, "precision", "recall", "hours_share").withColumn("hours", F.round("hours", 4))


@query("q31_top_pct_metrics", _top_sql("round_even(n * percent / 100, 0)::bigint"))
def top_pct_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _top(metrics.top_share_metrics(_judged(spark, d), [1, 5, 12.5, 40]))


@query("q32_precision_at_topk", _top_sql("floor(n * percent / 100)::bigint"))
def precision_at_topk(spark: SparkSession, d: str) -> DataFrame:
    return _top(metrics.top_share_metrics(_judged(spark, d), [1, 5, 12.5, 40], "floor"))


@query("q33_quantile_bands", f"with {SQL_QC}, q as (select quantile_cont(score, 0.9) as a, quantile_cont(score, 0.8) as b, quantile_cont(score, 0.2) as c from judged) select id, case when score >= a then 'top' when score >= b then 'high' when score >= c then 'mid' else 'low' end as band from judged, q")
def quantile_bands(spark: SparkSession, d: str) -> DataFrame:
    return sampling.quantile_bands(_judged(spark, d), "score", [0.9, 0.8, 0.2], ["top", "high", "mid", "low"]).select("id", "band")


@query("q34_action_metrics", f"""with {SQL_QC}, a as (select count(*) filter (score >= 0.6) as keep_n, count(*) filter (score >= 0.6 and kind <> 'F') as kg, coalesce(sum(duration_seconds) filter (score >= 0.6), 0) / 3600 as keep_hours, sum(coalesce(duration_seconds, 0)) / 3600 as hours, count(*) filter (score < 0.2) as drop_n, count(*) filter (score < 0.2 and kind <> 'F') as dg from judged)
select keep_n, round(case when keep_n = 0 then 0 else kg / keep_n end, 6) as keep_precision, round(keep_hours, 6) as keep_hours, round(case when hours > 0 then keep_hours / hours else 0 end, 6) as keep_hour_share, drop_n, round(case when drop_n = 0 then 1 else dg / drop_n end, 6) as drop_overturn from a""")
def action_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.action_metrics(_judged(spark, d), 0.2, 0.6), "keep_precision", "keep_hours", "keep_hour_share", "drop_overturn")


@query("q34b_score_actions", "select video_id, ml_score, case when ml_score < 0.15 then 'drop' when ml_score >= 0.85 then 'keep_candidate' else 'uncertain' end as action, case when ml_score <= 0.2 then 'high' when ml_score <= 0.5 then 'mid' when ml_score is not null then 'low' end as band from scored where not isnan(ml_score) or ml_score is null")
def score_actions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "scored").where(~F.isnan("ml_score") | F.col("ml_score").isNull())
    return s.select("video_id", "ml_score", scoring.action("ml_score", 0.15, 0.85).alias("action"), scoring.confidence_band("ml_score").alias("band"))


@query("q34c_direct_metrics", f"""with {SQL_QC}, p as (select kind, case when score >= 0.6 then 'T' when score < 0.3 then 'F' when score is not null then 'U' end as p from qc where kind is not null),
a as (select count(*) as n, count(*) filter (p in ('T', 'F')) as valid, count(*) filter (p = 'T') as t, count(*) filter (p = 'T' and kind <> 'F') as tg, count(*) filter (p = 'F') as f, count(*) filter (p = 'F' and kind <> 'F') as fg from p)
select n, valid, round(valid / greatest(n, 1), 6) as coverage, t as predicted_t, round(case when t = 0 then 0 else tg / t end, 6) as precision_t, f as predicted_f, round(case when f = 0 then 1 else fg / f end, 6) as overturn_f, round(case when valid = 0 then 0 else (tg + f - fg) / valid end, 6) as accuracy from a""")
def direct_metrics(spark: SparkSession, d: str) -> DataFrame:
    p = qc(spark, d).withColumn("p", F.when(F.col("score") >= 0.6, "T").when(F.col("score") < 0.3, "F").when(F.col("score").isNotNull(), "U"))
    return _r(metrics.direct_metrics(p, "p"), "coverage", "precision_t", "overturn_f", "accuracy")


@query("q34d_projection", f"with {SQL_QC} select count(*) as rows, round(coalesce(sum(duration_seconds), 0) / 3600, 4) as hours, round(count(*) * 1.5 / 3 / 3600, 6) as step_hours, round(coalesce(sum(duration_seconds), 0) / 3600 * 0.4, 4) as keep_hours from qc")
def projection(spark: SparkSession, d: str) -> DataFrame:
    p = metrics.projection(qc(spark, d), 1.5, 3, 0.4)
    return p.select("rows", F.round("hours", 4).alias("hours"), F.round("step_hours", 6).alias("step_hours"), F.round("keep_hours", 4).alias("keep_hours"))


@query("q34e_gate_reasons", f"with {SQL_QC}, a as (select count(*) filter (score < 0.3) as nd, count(*) filter (score < 0.3 and kind = 'F') as fc, count(*) filter (score < 0.3 and kind = 'T') as th, count(*) filter (score < 0.3 and kind = 'U') as uh, count(*) filter (kind = 'U') as nu from judged) select nd as n_drop, concat_ws(',', case when fc / greatest(nd, 1) < 0.95 then 'precision' end, case when th > 0 then 't_hurt' end, case when uh / greatest(nu, 1) > 0.01 then 'u_rate' end, case when nd = 0 then 'no_drop' end) as reasons from a")
def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return models.gate_reasons(metrics.threshold_metrics(_judged(spark, d), 0.3)).select("n_drop", F.array_join("reasons", ",").alias("reasons"))


@query("q35_source_weights", f"with {SQL_QC} select source, count(*) as n, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight from qc where source is not null group by source")
def source_weights(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.source_weights(qc(spark, d).where("source is not null"), "source"), "weight")


@query("q36_per_source_thresholds", f"""with {SQL_QC.replace("score is not null)", "score is not null and source is not null)")}, t as (select round(i * 0.01, 2)::double as threshold from range(1, 100) as r(i)),
c as (select source, threshold, count(*) filter (score >= threshold) as kept, count(*) filter (score >= threshold and kind <> 'F') as good, count(*) filter (score < threshold) as nd, count(*) filter (score < threshold and kind <> 'F') as hurt from judged, t group by 1, 2),
k as (select source, threshold as keep_threshold, ok as keep_met from (select *, row_number() over (partition by source order by ok desc, case when ok then 0 else -p end, threshold) as r from (select *, good / greatest(kept, 1) as p, good / greatest(kept, 1) >= 0.8 as ok from c where kept >= 5)) where r = 1),
x as (select source, threshold as drop_threshold, ok as drop_met from (select *, row_number() over (partition by source order by ok desc, case when ok then 0 else o end, threshold desc) as r from (select *, case when nd = 0 then 1.0 else hurt / nd end as o, case when nd = 0 then 1.0 else hurt / nd end <= 0.6 as ok from c where nd >= 5)) where r = 1)
select source, keep_threshold, keep_met, drop_threshold, drop_met from k full join x using (source)""")
def per_source_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return thresholds.action_thresholds(_judged(spark, d).where("source is not null"), 0.8, 0.6, 5, 5, ["source"])


MD5 = "md5('42:' || id)"


@query("q46_hash_sample", f"with {SQL_QC} select id from qc order by {MD5}, id limit 100")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.hash_sample(qc(spark, d), 100, 42, "id").select("id")


@query("q47_balanced_sample", f"with {SQL_QC}, r as (select id, kind, row_number() over (partition by kind order by {MD5}, id) as n, (select min(c) from (select count(*) as c from qc where kind in ('T', 'F') group by kind)) as least from qc where kind in ('T', 'F')) select id, kind from r where n <= least(150, least)")
def balanced_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balanced_sample(qc(spark, d), "kind", ["T", "F"], 300, 42, "id").select("id", "kind")


@query("q48_stratified_band_sample", f"with {SQL_QC}, q as (select quantile_cont(score, 0.9) as a, quantile_cont(score, 0.8) as b, quantile_cont(score, 0.2) as c from judged), x as (select id, case when score >= a then 'top' when score >= b then 'high' when score >= c then 'mid' else 'low' end as band from judged, q), r as (select *, row_number() over (partition by band order by {MD5}, id) as n from x) select id, band from r where n <= 30")
def stratified_band_sample(spark: SparkSession, d: str) -> DataFrame:
    b = sampling.quantile_bands(_judged(spark, d), "score", [0.9, 0.8, 0.2], ["top", "high", "mid", "low"])
    return sampling.sample_per_group(b, "band", 30, 42, "id").select("id", "band")


@query("q49_blind_sample", f"""with c as (select row_id as id, channel, nullif(try_cast(duration_seconds as double), 'nan'::double) as s from candidates where channel is not null and ({sql_video('video_id')} is null or {sql_video('video_id')} not in (select {sql_video('video_id')} from labels where {sql_video('video_id')} is not null))), f as (select * from c where s is not null),
q as (select quantile_cont(s, 0.8) as a, quantile_cont(s, 0.6) as b, quantile_cont(s, 0.4) as c, quantile_cont(s, 0.2) as e from f), x as (select id, channel, case when s >= a then '5' when s >= b then '4' when s >= c then '3' when s >= e then '2' else '1' end as sample_stratum from f, q),
o as (select *, row_number() over (partition by channel order by md5('7:' || id), id) as n from x), t as (select id, channel, sample_stratum, row_number() over (partition by sample_stratum order by md5('7:' || id), id) as n from o where n = 1)
select id, channel, sample_stratum from t order by n, sample_stratum limit 60""")
def blind_sample(spark: SparkSession, d: str) -> DataFrame:
    from siftline.functions.text import number

    c = table(spark, d, "candidates").select(F.col("row_id").alias("id"), "channel", number("duration_seconds").alias("s"), bare_video_id("video_id").alias("video"))
    labelled = table(spark, d, "labels").select(bare_video_id("video_id").alias("video"))
    return sampling.spread_sample(c, 60, 7, "id", "channel", "s", exclude=labelled, on="video").select("id", "channel", "sample_stratum")


@query("q50_active_learning_routes", f"""with {SQL_QC}, a as (select *, case when score < 0.3 then 'drop' when score >= 0.6 then 'keep_candidate' else 'uncertain' end as action from judged), b as (select id from a order by abs(score - 0.5), id limit 40), r as (select * from a where id not in (select id from b))
select id, 'boundary' as route from b union all (select id, 'diverse_keep' as route from r where action = 'keep_candidate' order by {MD5}, id limit 30) union all (select id, 'drop_overturn' as route from r where action = 'drop' order by {MD5}, id limit 20)""")
def active_learning_routes(spark: SparkSession, d: str) -> DataFrame:
    a = _judged(spark, d).withColumn("action", scoring.action("score", 0.3, 0.6))
    return sampling.active_routes(a, "score", "action", {"boundary": 40, "diverse_keep": 30, "drop_overturn": 20}, 42, "id").select("id", "route")


@query("q50b_diverse_keep")
def diverse_keep(spark: SparkSession, d: str) -> DataFrame:
    """Review rows by route, the kept ones far apart by their vectors (k-center)."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    a = _judged(spark, d).withColumn("action", scoring.action("score", 0.3, 0.6)).join(e, "id")
    return sampling.active_routes(a, "score", "action", {"boundary": 40, "diverse_keep": 30, "drop_overturn": 20}, 42, "id", "embedding").select("id", "route")


@query("q51_grouped_split", f"""with l as (select label_id, {sql_video('video_id')} as video, {KIND} as kind, coalesce({sql_present('channel')}, {sql_present('source_ref')}, {sql_present('video_id')}, 'row ' || label_id) as label_group from labels),
bad as (select video from l where kind in ('T', 'F') and video is not null group by video having count(distinct kind) > 1), h as (select *, ('0x' || substr(md5('9:' || label_group), 1, 8))::bigint / 4294967296.0 as h from l)
select label_id, label_group, case when video in (select video from bad) then 'review' when h < 0.7 then 'train' when h < 0.85 then 'calibration' else 'holdout' end as split from h""")
def grouped_split(spark: SparkSession, d: str) -> DataFrame:
    """Whole groups go to one split; rows of videos with contradicting verdicts go to review."""
    lab = table(spark, d, "labels").withColumn("video", bare_video_id("video_id")).withColumn("kind", kind("qc_result"))
    bad = lab.where("kind in ('T', 'F') and video is not null").groupBy("video").agg(F.countDistinct("kind").alias("k")).where("k > 1").join(lab.select("video", "label_id"), "video").select("label_id")
    s = sampling.labelled_split(lab.drop("label_group", "split"), ["channel", "source_ref", "video_id"], "label_id", {"train": 70, "calibration": 15, "holdout": 15}, 9, bad)
    return s.select("label_id", "label_group", "split")


@query("q52_wilson_gate", f"""with {SQL_QC}, a as (select count(*) filter (kind in ('T', 'F') and score >= 0.2) as n, count(*) filter (kind = 'T' and score >= 0.2) as passed, coalesce(sum(duration_seconds) / 3600, 0) as hours, count(*) filter (kind in ('T', 'F') and score < 0.2) as n_drop, count(*) filter (kind = 'T' and score < 0.2) as overturned from judged),
b as (select *, case when n > 0 then greatest(0, (passed / n + {Z90} ** 2 / (2 * n) - {Z90} * sqrt(passed / n * (1 - passed / n) / n + {Z90} ** 2 / (4 * n * n))) / (1 + {Z90} ** 2 / n)) else 0 end as lower, case when n_drop = 0 then 0 else overturned / n_drop end as overturn from a)
select n, passed, round(hours, 6) as hours, n_drop, overturned, round(lower, 6) as lower, round(overturn, 6) as overturn, (lower >= 0.6 and hours >= 100 and overturn <= 0.7) as accepted from b""")
def wilson_gate(spark: SparkSession, d: str) -> DataFrame:
    return _r(metrics.acceptance(_judged(spark, d), 0.6, 100, 0.7, 0.2), "hours", "lower", "overturn")


@query("q53_lot_decide", f"with {SQL_QC}, v as (select case kind when 'T' then 'pass' when 'F' then 'fail' end as verdict from qc join labels on label_id = id where split = 'holdout') select count(*) filter (verdict is not null) as n, count(*) filter (verdict = 'pass') as passed, round(count(*) filter (verdict = 'pass') / greatest(count(*) filter (verdict is not null), 1), 6) as pass_rate, case when count(*) filter (verdict is not null) > 0 and count(*) filter (verdict = 'pass') / greatest(count(*) filter (verdict is not null), 1) >= 0.85 then 'accept' else 'reject' end as decision from v")
def lot_decide(spark: SparkSession, d: str) -> DataFrame:
    lot = qc(spark, d)  # the members of one split are judged for the lot: the feature of acceptance sampling
    judged = table(spark, d, "labels").where("split = 'holdout'").select(F.col("label_id").alias("id"))
    verdicts = lot.join(judged, "id").select("id", F.when(F.col("kind") == "T", "pass").when(F.col("kind") == "F", "fail").alias("verdict"))
    return _r(metrics.lot_decision(lot, verdicts, 0.85, "id"), "pass_rate")


@query("q54_qc_stats_board", "select source, count(*) filter (upper(trim(qc_result)) = 'T') as n_t, count(*) filter (upper(trim(qc_result)) = 'F') as n_f, count(*) filter (upper(trim(qc_result)) = 'ERROR') as n_error, count(*) filter (coalesce(trim(qc_result), '') = '') as pending, count(*) filter (coalesce(trim(qc_result), '') <> '') as done from labels group by source")
def qc_stats_board(spark: SparkSession, d: str) -> DataFrame:
    return metrics.status_board(table(spark, d, "labels"), "qc_result", "source")


TAG = "case when regexp_matches(lower(coalesce(title, '')), 'oven|stove') then 'kitchen' when regexp_matches(lower(coalesce(title, '')), 'lathe|saw|welding') then 'metal' when regexp_matches(lower(coalesce(title, '')), 'garden|hive') then 'garden' end"


def _proposals(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower(F.coalesce("title", F.lit("")))
    tag = F.when(low.rlike("oven|stove"), "kitchen").when(low.rlike("lathe|saw|welding"), "metal").when(low.rlike("garden|hive"), "garden")
    q = qc(spark, d)
    return tags.propose(q.where("score < 0.5"), "id", tag, F.col("score"), "text", "title_rule").unionByName(tags.propose(q.where("kind = 'F'"), "id", tag, F.lit(0.3), "thumb", "thumb_qc"))


def _validated(spark: SparkSession, d: str) -> DataFrame:
    p = _proposals(spark, d)
    act = F.when(F.col("id") % 3 == 0, "confirm").when(F.col("id") % 3 == 1, "correct").otherwise("overturn")
    return p.where(F.col("reject_tag") != "garden").withColumn("reject_action", act)


PROPOSED = f"{SQL_QC}, p as (select id, {TAG} as reject_tag, 'text' as modality, 'title_rule' as propose_source, case when score <= 0.2 then 'high' else 'mid' end as confidence_band from qc where score < 0.5 union all select id, {TAG}, 'thumb', 'thumb_qc', 'mid' from qc where kind = 'F'), props as (select * from p where reject_tag is not null)"


@query("q55_reject_propose", f"with {PROPOSED} select id, reject_tag, modality, propose_source, confidence_band from props")
def reject_propose(spark: SparkSession, d: str) -> DataFrame:
    return _proposals(spark, d)


@query("q57_reject_metrics", f"""with {PROPOSED}, v as (select *, id % 3 as m from props where reject_tag <> 'garden'), c as (select reject_tag, modality, propose_source, count(*) as n_proposed from props group by all),
w as (select reject_tag, modality, propose_source, count(*) as n_validated, count(*) filter (m = 0) as n_confirm, count(*) filter (m = 1) as n_correct, count(*) filter (m = 2) as n_overturn from v group by all),
x as (select reject_tag, modality, propose_source, n_proposed, coalesce(n_validated, 0) as n_validated, coalesce(n_confirm, 0) as n_confirm, coalesce(n_correct, 0) as n_correct, coalesce(n_overturn, 0) as n_overturn from c left join w using (reject_tag, modality, propose_source))
select *, round(case when n_validated > 0 then (n_confirm + n_correct) / n_validated end, 6) as precision_proxy, round(case when n_validated > 0 then n_overturn / n_validated end, 6) as overturn_rate, case when n_validated < 30 or n_overturn / n_validated > 0.35 then 'untrusted' else 'trusted' end as trust_status,
  case when n_validated < 30 then 'collect_more_validation' when n_overturn / n_validated > 0.35 then 'review_rule' else 'keep' end as suggestion from x""")
def reject_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _r(tags.metrics(_proposals(spark, d), _validated(spark, d)), "precision_proxy", "overturn_rate")


@query("q57b_reject_totals", f"with {PROPOSED} select count(*)::bigint as n_proposed, count(distinct reject_tag) as n_tags, list_sort(list(distinct reject_tag) filter (reject_tag = 'garden')) as tags_with_prop_no_val from props")
def reject_totals(spark: SparkSession, d: str) -> DataFrame:
    return tags.totals(_proposals(spark, d), _validated(spark, d))


@query("q57c_modality_counts", f"with {PROPOSED} select reject_tag, count(*)::bigint as n, string_agg(distinct modality, ',' order by modality) as modalities from props group by reject_tag")
def modality_counts(spark: SparkSession, d: str) -> DataFrame:
    m = tags.modality_counts(_proposals(spark, d))
    return m.select("reject_tag", "n", F.array_join(F.array_sort(F.map_keys("by_modality")), ",").alias("modalities"))


@query("q61_boundary_decision", "with s as (select batch_no, sum(case when contains(lower(coalesce(title, '')), 'zzz') then 1 else 0 end) as hits from candidates group by batch_no order by batch_no desc limit 2) select count(*) as n, (count(*) = 2 and sum(hits) = 0) as boundary from s")
def boundary_decision(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "candidates").groupBy("batch_no").agg(F.sum(F.lower(F.coalesce("title", F.lit(""))).contains("zzz").cast("int")).alias("hits"))
    return tags.boundary(s, "batch_no", "hits")


def _labelled_titles(spark: SparkSession, d: str) -> DataFrame:
    return qc(spark, d).where("kind in ('T', 'F')").withColumn("y", (F.col("kind") != "F").cast("int"))


@query("q63_lr_oof_scores")
def lr_oof_scores(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold scores of a balanced logistic regression on title terms."""
    return models.out_of_fold(models.text_columns(_labelled_titles(spark, d), "title"), "id", "y", models.logistic_pipeline, 3)


@query("q63b_svm_oof_scores")
def svm_oof_scores(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold margins of a linear SVM on title terms, as calibrated probabilities."""
    return models.calibrated_svm(models.text_columns(_labelled_titles(spark, d), "title"), "id", "y")


@query("q63c_top_terms")
def top_terms(spark: SparkSession, d: str) -> DataFrame:
    """The 20 terms that speak most for, and most against, a good verdict."""
    train = models.balanced(models.text_columns(_labelled_titles(spark, d), "title"))
    model = models.text_pipeline(models.logistic(train.agg(F.sum("weight")).first()[0]), vocabulary=20_000).fit(train)
    return models.top_terms(model, spark)


@query("q63d_hold_out", f"with {SQL_QC} select kind, count(*) as n, true as share_met from qc where kind is not null group by kind")
def hold_out(spark: SparkSession, d: str) -> DataFrame:
    """Per class, whether a fifth is held out, to within a row in each of the 64 parts in which it is drawn."""
    h = sampling.hold_out(qc(spark, d).where("kind is not null"), "id", "kind", 0.2, 42)
    g = h.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.col("held").cast("int")).alias("held"))
    return g.select("kind", "n", (F.abs(F.col("held") - 0.2 * F.col("n")) <= 64).alias("share_met"))


GROUP = f"coalesce({sql_present('channel')}, {sql_present('source_ref')}, {sql_present('video_id')})"


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    """Judged label rows with title, y and group: channel, else source_ref, else video, else the row itself."""
    g = table(spark, d, "labels").select(F.col("label_id").alias("id"), F.coalesce(group_id("channel", "source_ref", "video_id"), F.concat(F.lit("row "), "label_id")).alias("g"))
    return _labelled_titles(spark, d).join(g, "id")


@query("q64_group_oof")
def group_oof(spark: SparkSession, d: str) -> DataFrame:
    """Scores of every row by a model that has seen no row of its group."""
    f = models.group_folds(models.text_columns(_grouped(spark, d), "title"), "g", "y", 5)
    return models.out_of_fold(f.withColumnRenamed("fold", "_fold"), "id", "y", models.logistic_pipeline, 5, fold_col="_fold")


@query("q64b_group_folds", f"with {SQL_QC} select count(*) as rows, count(distinct coalesce({GROUP}, 'row ' || label_id)) as groups, 0::bigint as split_groups, 5::bigint as folds from labels join qc on label_id = id where kind in ('T', 'F')")
def group_folds(spark: SparkSession, d: str) -> DataFrame:
    """Rows, groups, groups that lie in two folds, and folds."""
    f = models.group_folds(_grouped(spark, d), "g", "y", 5)
    g = f.groupBy("g").agg(F.countDistinct("fold").alias("k"), F.count("*").alias("n"))
    folds = f.agg(F.countDistinct("fold").alias("folds"))
    return g.agg(F.sum("n").alias("rows"), F.count("*").alias("groups"), F.count(F.when(F.col("k") > 1, 1)).alias("split_groups")).crossJoin(F.broadcast(folds))  # one row each


@query("q64c_fusion_oof")
def fusion_oof(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold scores, by group, of a logistic regression on word and character terms and filled, scaled numbers."""
    q = models.text_columns(_grouped(spark, d), "title", (1, 2), (3, 5)).withColumn("length", F.length("title").cast("double"))
    f = models.group_folds(q, "g", "y", 5).withColumnRenamed("fold", "_fold")
    return models.fusion_scores(f, "id", "y", ["score", "duration_seconds", "length"], 5, "_fold")
