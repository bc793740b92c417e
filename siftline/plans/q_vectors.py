"""Queries on embedding vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import scoring
from siftline.operators import vectors
from siftline.plans.catalogue import query
from siftline.session import table

SIZE = 64
PAIRS = {"q1": (0, 1), "q2": (2, 3), "q3": (4, 5)}
SQL_CENTROIDS = f"""flat as (select vec_id, label, i, embedding[i]::double as x from embeddings, range(1, {SIZE + 1}) as r(i)),
cent as (select label, i, avg(x) as c from flat group by label, i), len as (select label, sqrt(sum(c * c)) as n from cent group by label), vlen as (select vec_id, sqrt(sum(x * x)) as n from flat group by vec_id),
sim as (select vec_id, cent.label as proto, sum(x * c) as dot from flat join cent using (i) group by 1, 2), cosines as (select vec_id, proto, dot / (len.n * vlen.n) as s from sim join len on proto = len.label join vlen using (vec_id))"""


def _cos(p: int) -> str:
    return f"max(s) filter (proto = {p})"


MARGINS = "m as (select vec_id, " + ", ".join(f"{_cos(a)} - {_cos(b)} as {q}" for q, (a, b) in PAIRS.items()) + " from cosines group by vec_id)"


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def _prototypes(spark: SparkSession, d: str) -> dict[int, list[float]]:
    return {r.label: r.centroid for r in vectors.centroids(_embeddings(spark, d), "label", "embedding", SIZE).collect()}  # one row per label


def _margins(spark: SparkSession, d: str) -> DataFrame:
    p = _prototypes(spark, d)
    return vectors.margins(_embeddings(spark, d), "embedding", {q: (p[a], p[b]) for q, (a, b) in PAIRS.items()})


@query("q37_proto_margin", f"with {SQL_CENTROIDS}, {MARGINS} select vec_id, round(q1, 6) as q1, round(q2, 6) as q2, round(q3, 6) as q3 from m")
def proto_margin(spark: SparkSession, d: str) -> DataFrame:
    return _margins(spark, d).select("vec_id", *(F.round(q, 6).alias(q) for q in PAIRS))


@query("q38_margin_decision", f"with {SQL_CENTROIDS}, {MARGINS} select vec_id, case when vec_id % 50 = 0 then 'no_thumb' when q1 >= 0.05 and q3 >= 0.0 then 'clip_pass' else 'clip_fail' end as clip_decision from m")
def margin_decision(spark: SparkSession, d: str) -> DataFrame:
    m = _margins(spark, d).withColumn("ok", F.col("vec_id") % 50 != 0)
    return vectors.decide(m, {"q1": 0.05}, ["q1", "q3"], "ok").select("vec_id", "clip_decision")


@query("q39_rethreshold", f"with {SQL_CENTROIDS}, {MARGINS}, t(t) as (values (-0.1), (0.0), (0.1), (0.2)) select t::double as threshold, count(*) filter (q1 >= t) as passed, count(*) as n from m, t group by t")
def rethreshold(spark: SparkSession, d: str) -> DataFrame:
    ts = [-0.1, 0.0, 0.1, 0.2]
    one = _margins(spark, d).agg(F.count("*").alias("n"), *(F.count(F.when(F.col("q1") >= t, 1)).alias(f"p{i}") for i, t in enumerate(ts)))
    return one.select("n", F.inline(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"p{i}").alias("passed")) for i, t in enumerate(ts)))))


SIMS = """pairs as (select a.vec_id as id, b.vec_id as mid, b.label as g, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::double * z[2]::double)) as s from embeddings a, embeddings b)"""


@query("q40_max_proto_contrast", f"with {SQL_CENTROIDS}, x as (select vec_id, max(dot) filter (proto in (0, 2, 4)) as k, max(dot) filter (proto in (1, 3, 5)) as dr from sim group by vec_id) select vec_id, round(greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-(k - dr) / 0.08)))), 6) as score from x")
def max_proto_contrast(spark: SparkSession, d: str) -> DataFrame:
    p = _prototypes(spark, d)
    v = F.col("embedding")
    keep, drop = vectors.max_similarity(v, [p[i] for i in (0, 2, 4)]), vectors.max_similarity(v, [p[i] for i in (1, 3, 5)])
    return _embeddings(spark, d).select("vec_id", F.round(scoring.contrast(keep, drop), 6).alias("score"))


@query("q41_loo_contrast", f"with {SIMS}, x as (select id, max(s) filter (g in (0, 2)) as k, max(s) filter (g in (1, 3)) as dr from pairs where id <> mid group by id) select id, round(k, 6) as sim_keep, round(dr, 6) as sim_drop, round(greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-(k - dr) / 0.08)))), 6) as score from x")
def loo_contrast(spark: SparkSession, d: str) -> DataFrame:
    e = _embeddings(spark, d).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    bank = e.where("label < 4").withColumn("group", F.when(F.col("label") % 2 == 0, "keep").otherwise("drop"))
    near = vectors.nearest(e, bank, 1, per_group=True, skip_self=True)
    return vectors.loo_contrast(near, "keep", "drop").select("id", *(F.round(c, 6).alias(c) for c in ("sim_keep", "sim_drop", "score")))


@query("q42_knn_topk", f"with {SIMS}, r as (select id, mid, g, s, row_number() over (partition by id order by round(s, 12) desc, mid) as rank from pairs where id <> mid) select id, rank::int as rank, mid as match_id, round(s, 6) as similarity from r where rank <= 5")
def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    e = _embeddings(spark, d).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("group"))
    return vectors.nearest(e, e, 5, skip_self=True).select("id", "rank", "match_id", F.round("similarity", 6).alias("similarity"))


@query("q43_exemplar_tiers", f"with {SQL_CENTROIDS}, x as (select vec_id, max(dot) filter (proto in (0, 1)) as s, max(dot) filter (proto = 9) as neg from sim group by vec_id) select vec_id, case when s >= 0.5 then 'high' when s >= 0.2 then 'mid' else 'low' end as tier, (s - neg >= 0.05) as margin_ok from x")
def exemplar_tiers(spark: SparkSession, d: str) -> DataFrame:
    p = _prototypes(spark, d)
    s = vectors.max_similarity(F.col("embedding"), [p[0], p[1]])
    return _embeddings(spark, d).select("vec_id", vectors.tiers(s, 0.5, 0.2).alias("tier"), (s - vectors.max_similarity(F.col("embedding"), [p[9]]) >= 0.05).alias("margin_ok"))


@query("q43b_prototype_scores", f"""with ks as (select embedding as p from embeddings where label = 0 order by vec_id limit 20), ds as (select embedding as p from embeddings where label = 1 order by vec_id limit 20),
s as (select vec_id, (select max(list_sum(list_transform(list_zip(e.embedding, p), lambda z: z[1]::double * z[2]::double))) from ks) as k, (select max(list_sum(list_transform(list_zip(e.embedding, p), lambda z: z[1]::double * z[2]::double))) from ds) as dr from embeddings e)
select vec_id, round(k, 6) as sim_keep, round(dr, 6) as sim_drop, round(greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-(k - dr) / 0.08)))), 6) as score from s""")
def prototype_scores(spark: SparkSession, d: str) -> DataFrame:
    """Rows scored by their nearest few-shot picks of two labels."""
    s = vectors.prototype_scores(_embeddings(spark, d), "vec_id", "embedding", F.col("label") == 0, F.col("label") == 1)
    return s.select("vec_id", *(F.round(c, 6).alias(c) for c in ("sim_keep", "sim_drop", "score")))


@query("q43c_feature_matrix", f"with {SQL_CENTROIDS}, x as (select vec_id, max(dot) filter (proto in (0, 2)) as p, max(dot) filter (proto in (1, 3)) as n from sim group by vec_id) select vec_id, 67 as size, round(p, 6) as pos_sim, round(n, 6) as neg_sim, round(ln(1 + vec_id), 6) as log_duration from x")
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    from siftline.operators.features import feature_array

    p = _prototypes(spark, d)
    f = _embeddings(spark, d).select("vec_id", feature_array("embedding", [p[0], p[2]], [p[1], p[3]], F.col("vec_id").cast("double")).alias("f"))
    return f.select("vec_id", F.size("f").alias("size"), *(F.round(F.col("f")[SIZE + i], 6).alias(c) for i, c in enumerate(("pos_sim", "neg_sim", "log_duration"))))


@query("q44_store_coverage_fingerprint", "select count(vec_id) as rows, bit_xor(('0x' || substr(md5(vec_id::varchar), 1, 15))::bigint) as ids_key, count(*) filter (abs(list_sum(list_transform(embedding, lambda x: x::double * x::double)) - 1) < 0.001) as unit_vectors from embeddings")
def store_coverage_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    e = _embeddings(spark, d)
    unit = e.agg(F.count(F.when(F.abs(vectors.dot(F.col("embedding"), F.col("embedding")) - 1) < 0.001, 1)).alias("unit_vectors"))
    return vectors.fingerprint(e, "vec_id").crossJoin(F.broadcast(unit))  # one row each
