"""Queries on text, labels and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions import labels, scoring, text
from siftline.operators import features, nested, rules, tags
from siftline.plans.catalogue import query
from siftline.plans.views import KIND, SQL_QC, qc, sql_present, sql_squeeze
from siftline.session import table

# Rules over the words of the test tables; real ones come from configuration.
SECTIONS = (
    rules.Section("title_blacklist", "title", ("bread oven", "chain ?saw", "welding torch"), category="tools"),
    rules.Section("title_aggressive_blacklist", "title", (r"(^|[^\p{L}])nobody told", "what happens when"), category="clickbait"),
    rules.Section("channel_blacklist", "channel", ("Bravuna Daily Clips", "Kulasara Workshop"), exact=True, category="channel"),
    rules.Section("empty_section", "title", ()),
)
STEP_SQL = """case when regexp_matches(lower(coalesce(title, '')), 'bread oven|chain ?saw|welding torch') then 'title_blacklist'
  when regexp_matches(lower(coalesce(title, '')), '(^|[^\\p{L}])nobody told|what happens when') then 'title_aggressive_blacklist'
  when trim(lower(coalesce(channel, ''))) in ('bravuna daily clips', 'kulasara workshop') then 'channel_blacklist' end"""
WORDS = ("workshop", "morning", "garden", "chair", "old", "diary", "official", "live", "friends", "storm", "oven", "stone", "lathe", "kettle")
PATTERNS = ("bread oven", "chain ?saw", "stone wall", "quiet morning", "garden hoe", "zzz+")
NOISE = {"reupload": "reupload|full$", "official": "official"}
INDUSTRIES = {"kitchen": "bread oven|coffee grinder|kettle|camp stove", "garden": "garden hoe|bee hive|apple press|roof gutter", "metal": "welding|lathe|chain ?saw|tool chest", "textile": "sewing|carpet|rain jacket"}


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidates")


def _case(mapping: dict[str, str], c: str = "lower(coalesce(title, ''))") -> str:
    return "case " + " ".join(f"when regexp_matches({c}, '{p}') then '{n}'" for n, p in mapping.items()) + " end"


@query("q01_rule_summary", f"""with a as (select {STEP_SQL} as drop_step from candidates)
select case when drop_step is null then 'keep' else 'drop' end as decision, drop_step, count(*) as n, round(count(*) * 100.0 / (select count(*) from a), 1)::double as pct from a group by drop_step""")
def rule_clean_summary(spark: SparkSession, d: str) -> DataFrame:
    return rules.summary(rules.attribute(_candidates(spark, d), SECTIONS))


@query("q02_build_text_title_channel", f"select row_id, {sql_squeeze("coalesce(title, '') || ' ' || coalesce(channel, '')")} as text from candidates")
def build_text_title_channel(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", text.title_with("channel").alias("text"))


@query("q03_build_text_desc_800", f"select row_id, {sql_squeeze("coalesce(title, '') || ' ' || substr(coalesce(description, ''), 1, 800)")} as text from candidates")
def build_text_desc(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", text.title_and_description(800).alias("text"))


@query("q04_build_text_year_tokens", f"""select row_id, {sql_squeeze("concat_ws(' ', coalesce(title, ''), regexp_replace(coalesce(keyword, ''), '(^|\\s)-[A-Za-z0-9*?]+', ' ', 'g'), case when regexp_matches(coalesce(title, ''), '\\(\\s*(19|20)[0-9]{2}\\s*\\)') then 'FILM_YEAR_TOKEN' end, case when regexp_matches(coalesce(title, ''), '(^|[^\\p{L}\\p{N}_])[0-9]{4}([^\\p{L}\\p{N}_]|$)') then 'HAS_YEAR_TOKEN' end)")} as text from candidates""")
def build_text_year_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", text.title_keyword_tokens().alias("text"))


@query("q04b_build_text_keyword_or_channel", f"""select row_id, {sql_squeeze("coalesce(title, '') || ' ' || coalesce(nullif(trim(coalesce(keyword, '')), ''), channel, '')")} as text from candidates""")
def build_text_keyword_or_channel(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", text.title_keyword_or_channel().alias("text"))


@query("q04c_build_text_joined", f"""select row_id, {sql_squeeze("concat_ws(' ', " + ", ".join(sql_present(c) for c in ("title", "keyword", "channel", "source_ref")) + ")")} as text from candidates""")
def build_text_joined(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", text.joined(text.parse_fields("title, keyword,channel,source_ref")).alias("text"))


@query("q05_keyword_flags", "select row_id, " + ", ".join(f"regexp_matches(lower(coalesce(title, '')), '(^|[^\\p{{L}}\\p{{N}}_])({w})([^\\p{{L}}\\p{{N}}_]|$)')::int as has_{w}" for w in WORDS) + ", contains(coalesce(url, ''), 'watch')::int as url_watch from candidates")
def keyword_flags(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", *text.word_flags("title", WORDS), text.contains_flag("url", "watch").alias("url_watch"))


@query("q06_length_features", f"""select row_id, length(coalesce(title, ''))::int as title_len, length(coalesce(description, ''))::int as desc_len, round(coalesce(s, 0) / 60, 6) as duration_min,
  (length(coalesce(description, '')) > 20)::int as has_desc, (case when {sql_squeeze("coalesce(title, '')")} = '' then 0 else len(string_split({sql_squeeze("coalesce(title, '')")}, ' ')) end)::int as title_wc,
  round(ln(1 + greatest(1, least(86400, coalesce(s, 600)))), 6) as duration_log from (select *, nullif(try_cast(duration_seconds as double), 'nan'::double) as s from candidates)""")
def length_features(spark: SparkSession, d: str) -> DataFrame:
    f = _candidates(spark, d).select("row_id", *text.length_features())
    return f.withColumn("duration_min", F.round("duration_min", 6)).withColumn("duration_log", F.round("duration_log", 6))


@query("q09_label_normalise", f"""select label_id, {KIND} as kind, case when upper(trim(qc_result)) in ('T', 'PASS') then 'T' when upper(trim(qc_result)) like 'F%' and not contains(upper(qc_result), '无法播放') and not contains(upper(qc_result), 'UNPLAYABLE') then 'F' end as strict,
  case when lower(trim(qc_result)) in ('t', '合格', 'pass') then 'pass' when lower(trim(qc_result)) in ('f', '不合格', 'fail') then 'fail' end as human,
  case when lower(trim(qc_bool)) in ('t', 'true') then true when lower(trim(qc_bool)) in ('f', 'false') then false end as flag,
  coalesce(upper(nullif(regexp_extract(coalesce(qc_result, ''), '(?:^|[^\\p{{L}}\\p{{N}}_])([TtFfUu])(?:[^\\p{{L}}\\p{{N}}_]|$)', 1), '')), 'ERROR') as verdict from labels""")
def label_normalise(spark: SparkSession, d: str) -> DataFrame:
    c = "qc_result"
    return table(spark, d, "labels").select("label_id", labels.kind(c).alias("kind"), labels.strict_label(c).alias("strict"), labels.human_label(c).alias("human"), labels.bool_label("qc_bool").alias("flag"), labels.answer(c).alias("verdict"))


@query("q10_l1_l2_route", f"""with a as (select row_id, {_case(NOISE)} as drop_category, list_filter([{", ".join(f"case when regexp_matches(lower(coalesce(title, '')), '{p}') then '{n}' end" for n, p in INDUSTRIES.items())}], lambda x: x is not null) as hits from candidates)
select row_id, drop_category, case when drop_category is null then hits[1] end as industry_primary, case when drop_category is null then len(hits) else 0 end::int as industries,
  case when drop_category is not null then 'l1_drop' when len(hits) > 0 then 'candidate' else 'unrouted' end as stage from a""")
def l1_l2_route(spark: SparkSession, d: str) -> DataFrame:
    r = rules.route(_candidates(spark, d), NOISE, INDUSTRIES)
    return r.select("row_id", "drop_category", "industry_primary", F.size("industries").alias("industries"), "stage")


@query("q11_rule_hit_counts", " union all ".join(f"select '{p}' as pattern, count(*) filter (regexp_matches(lower(coalesce(title, '')), '{p}')) as hits from candidates" for p in PATTERNS))
def rule_hit_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.hit_counts(_candidates(spark, d), "title", PATTERNS)


@query("q12_drop_step_attribution", f"select row_id, {STEP_SQL} as drop_step, case when ({STEP_SQL}) is null then 'keep' else 'drop' end as decision from candidates")
def drop_step_attribution(spark: SparkSession, d: str) -> DataFrame:
    return rules.attribute(_candidates(spark, d), SECTIONS).select("row_id", "drop_step", "decision")


@query("q12b_prefilter_reason", """select row_id, case when lower(trim(channel)) in ('kezakupe') then 'l0:channel_blacklist' when s < 60 then 'l0:too_short:' || floor(s)::bigint || 's' when s > 10000 then 'l0:too_long:' || floor(s)::bigint || 's'
  when contains(lower(coalesce(title, '')), 'official') then 'l0:title:official' end as reason from (select *, nullif(try_cast(duration_seconds as double), 'nan'::double) as s from candidates)""")
def prefilter_reason(spark: SparkSession, d: str) -> DataFrame:
    reason = rules.prefilter_reason(F.floor(text.number("duration_seconds")), F.col("channel"), F.col("title"), ["Kezakupe"], 60, 10_000, ["official"])
    return _candidates(spark, d).select("row_id", reason.alias("reason"))


@query("q12c_first_match_cluster", """select row_id, case when contains(lower(coalesce(title, '')), 'live') and s > 3000 then 'long_live' when contains(lower(coalesce(title, '')), 'live') then 'live' when s < 100 then 'short' else 'other' end as cluster
from (select *, coalesce(nullif(try_cast(duration_seconds as double), 'nan'::double), 0) as s from candidates)""")
def first_match_cluster(spark: SparkSession, d: str) -> DataFrame:
    low, s = F.lower(text.filled("title")), F.coalesce(text.number("duration_seconds"), F.lit(0.0))
    return _candidates(spark, d).select("row_id", rules.first_match([("long_live", low.contains("live") & (s > 3000)), ("live", low.contains("live")), ("short", s < 100)], "other").alias("cluster"))


KEEP, RESCUE, BLOCK = ("live", "morning"), ("oven", "lathe", "garden"), ("reupload", "full$")


@query("q12d_rescued", "select row_id, " + " and ".join(f"{no}regexp_matches(lower(coalesce(title, '')), '{'|'.join(p)}')" for no, p in (("", KEEP), ("", RESCUE), ("not ", BLOCK))) + " as rescued from candidates")
def rescued(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("row_id", rules.rescued("title", KEEP, RESCUE, BLOCK).alias("rescued"))


@query("q20_nested_formats_max_height", """with f as (select row_id, [{'id': 'sb0', 'note': 'storyboard', 'h': 45, 'r': '80x45', 'v': 'none'}, {'id': '140', 'note': 'medium', 'h': null, 'r': 'audio only', 'v': 'none'}]
  || case row_id % 5 when 0 then [{'id': '134', 'note': null, 'h': 360, 'r': '640x360', 'v': 'avc1'}] when 1 then [{'id': '136', 'note': '720p60', 'h': null, 'r': null, 'v': 'avc1'}] when 2 then [{'id': '137', 'note': null, 'h': null, 'r': '1080x1920', 'v': 'avc1'}, {'id': '17', 'note': null, 'h': 48, 'r': null, 'v': 'avc1'}] when 3 then [{'id': '17', 'note': null, 'h': 48, 'r': null, 'v': 'avc1'}] else [] end as formats from candidates),
h as (select row_id, formats, list_filter(list_transform(list_filter(formats, lambda x: x.v <> 'none' and coalesce(x.note, '') <> 'storyboard'),
  lambda x: coalesce(x.h, case when regexp_matches(coalesce(x.r, ''), '^[0-9]+x[0-9]+$') then greatest(string_split(x.r, 'x')[1]::int, string_split(x.r, 'x')[2]::int) end, try_cast(regexp_extract(coalesce(x.note, ''), '^([0-9]{3,4})p', 1) as int))), lambda y: y >= 100) as heights from f)
select row_id, list_max(heights)::int as max_height, case when len(heights) > 0 then null when len(list_filter(formats, lambda x: x.v <> 'none')) = 0 then 'NO_HEIGHT' else 'EMPTY_FORMATS' end as status from h""")
def nested_formats(spark: SparkSession, d: str) -> DataFrame:
    def fmt(i: str, note: str | None, h: int | None, r: str | None, v: str) -> str:
        q = lambda x: "cast(null as string)" if x is None else f"'{x}'"
        return f"named_struct('format_id', {q(i)}, 'format_note', {q(note)}, 'height', {'cast(null as int)' if h is None else h}, 'resolution', {q(r)}, 'vcodec', {q(v)}, 'acodec', 'mp4a', 'fragments', cast(null as array<struct<url:string>>))"

    base = f"array({fmt('sb0', 'storyboard', 45, '80x45', 'none')}, {fmt('140', 'medium', None, 'audio only', 'none')})"
    low = fmt("17", None, 48, None, "avc1")
    more = f"case row_id % 5 when 0 then array({fmt('134', None, 360, '640x360', 'avc1')}) when 1 then array({fmt('136', '720p60', None, None, 'avc1')}) when 2 then array({fmt('137', None, None, '1080x1920', 'avc1')}, {low}) when 3 then array({low}) else filter({base}, x -> false) end"
    f = _candidates(spark, d).select("row_id", F.expr(f"concat({base}, {more})").alias("formats"))
    return f.select("row_id", nested.max_height(F.col("formats")).alias("max_height"), nested.missing_height_status(F.col("formats")).alias("status"))


@query("q20b_sample_indices", "select row_id, case when row_id % 200 = 0 then 0 else row_id % 200 end::bigint as total, list_sum(case when row_id % 200 <= 6 then range(row_id % 200) else list_transform(range(6), lambda i: floor((i + 0.5) * (row_id % 200) / 6)::bigint) end)::bigint as index_sum from candidates")
def sample_indices(spark: SparkSession, d: str) -> DataFrame:
    total = (F.col("row_id") % 200).cast("bigint")
    i = scoring.sample_indices(total, 6)
    return _candidates(spark, d).select("row_id", total.alias("total"), F.when(F.size(i) > 0, F.aggregate(i, F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("index_sum"))


@query("q20c_person_frames", """with b as (select event_id, [case when user_id % 4 = 0 then null else list_transform(range(event_id % 3), lambda i: {'x0': 10.0 * i, 'y0': 5.0, 'x1': 10.0 * i + value, 'y1': 45.0}) end, list_transform(range(user_id % 2), lambda i: {'x0': 0.0, 'y0': 0.0, 'x1': 20.0, 'y1': 30.0}), null] as boxes from events),
s as (select event_id, len(list_filter(boxes, lambda x: coalesce(len(x), 0) > 0)) as persons, list_max(list_transform(flatten(list_filter(boxes, lambda x: x is not null)), lambda r: (r.x1 - r.x0) * (r.y1 - r.y0))) / 7200.0 as share from b)
select event_id, persons::int as persons, round(share, 6) as share, case when persons >= 1 and coalesce(share, 0) >= 0.1 then 'T' when persons = 0 then 'F' else 'U' end as verdict from s""")
def person_frames(spark: SparkSession, d: str) -> DataFrame:
    none = "cast(null as array<struct<x0:double,y0:double,x1:double,y1:double>>)"

    def boxes(n: str, x1: str, y0: str, y1: str, x0: str) -> str:
        return f"case when {n} > 0 then transform(sequence(0, cast({n} as int) - 1), i -> named_struct('x0', {x0}, 'y0', {y0}, 'x1', {x1}, 'y1', {y1})) else filter(array(named_struct('x0', 0D, 'y0', 0D, 'x1', 0D, 'y1', 0D)), x -> false) end"

    first = f"case when user_id % 4 = 0 then {none} else {boxes('event_id % 3', '10D * i + value', '5D', '45D', '10D * i')} end"
    e = table(spark, d, "events").select("event_id", F.expr(f"array({first}, {boxes('user_id % 2', '20D', '0D', '30D', '0D')}, {none})").alias("boxes"))
    share = nested.box_share(F.col("boxes"), 120, 60)
    return e.select("event_id", nested.person_frames(F.col("boxes")).alias("persons"), F.round(share, 6).alias("share"), nested.frame_verdict(F.col("boxes"), share, 1, 0.1).alias("verdict"))


@query("q59_pattern_score", f"with {SQL_QC} " + " union all ".join(f"select '{p}' as pattern, count(*) filter (kind = 'F' and h) as n_f, count(*) filter (kind = 'T' and h) as n_t, count(*) filter (kind = 'U' and h) as n_u, (count(*) filter (kind = 'F' and h) >= 3 and count(*) filter (kind = 'T' and h) = 0 and count(*) filter (kind = 'U' and h) = 0) as addable from (select kind, regexp_matches(lower(coalesce(title, '')), '{p}') as h from qc)" for p in PATTERNS))
def pattern_score(spark: SparkSession, d: str) -> DataFrame:
    return rules.pattern_scores(qc(spark, d), "title", "kind", PATTERNS)


@query("q60_ngram_mining", f"""with {SQL_QC}, w as (select id, kind, list_filter(regexp_split_to_array(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '') as w from qc where kind is not null),
g as (select distinct id, kind, w[i] || ' ' || w[i + 1] as ngram from (select id, kind, w, unnest(range(1, len(w))) as i from w))
select ngram, count(*) filter (kind = 'F') as n_f from g group by ngram having count(*) filter (kind = 'F') >= 2 and count(*) filter (kind <> 'F') = 0""")
def ngram_mining(spark: SparkSession, d: str) -> DataFrame:
    return rules.mine_ngrams(qc(spark, d), "title", "kind", 2, 2)


REGISTRY = [("lathe", "车床", "active", ["old lathe", "tornio"], None), ("oven", "面包炉", "active", ["bread oven"], None), ("stove", "露营炉", "deprecated", ["camp stove"], "oven")]


@query("q58_tag_normalise", """with r(id, label, target, alias) as (values ('lathe', '车床', 'lathe', ['old lathe', 'tornio']), ('oven', '面包炉', 'oven', ['bread oven']), ('stove', '露营炉', 'oven', ['camp stove'])),
a as (select lower(trim(x)) as alias, arg_min(target, id) as canonical from (select id, target, unnest([id, label] || alias) as x from r) group by 1),
t as (select row_id, generate_subscripts(l, 1) - 1 as pos, trim(unnest(l)) as raw from (select row_id, string_split_regex(coalesce(keyword, '') || ',bread oven|Camp Stove, 车床', '[,|]') as l from candidates)),
n as (select row_id, pos, raw, coalesce(canonical, 'provisional:' || raw) as tag from t left join a on lower(raw) = a.alias where raw <> '')
select row_id, tag, min(pos)::int as pos from n group by row_id, tag""")
def tag_normalise(spark: SparkSession, d: str) -> DataFrame:
    registry = spark.createDataFrame(REGISTRY, "id string, label_zh string, status string, aliases array<string>, maps_to string")
    t = _candidates(spark, d).select("row_id", F.concat(F.coalesce("keyword", F.lit("")), F.lit(",bread oven|Camp Stove, 车床")).alias("tags"))
    return tags.normalise(t, "row_id", "tags", registry).select("row_id", "tag", "pos")


@query("q62_tfidf_weights", """with tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}')) as term from documents) group by 1, 2),
v as (select term, ln((1 + (select count(*) from documents)) / (1 + count(*))) + 1 as idf from tf group by term having count(*) >= 2), w as (select doc_id, term, (1 + ln(tf)) * idf as raw from tf join v using (term))
select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 6) as weight from w""")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    w = features.tfidf(table(spark, d, "documents"), "doc_id", features.tokens("text"), min_df=2)
    return w.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("q62b_char_wb_ngrams", """with w as (select label_id, ' ' || unnest(list_filter(regexp_split_to_array(lower(coalesce(title, '')), '\\s+'), lambda x: x <> '')) || ' ' as f from labels),
g as (select label_id, unnest(case when length(f) = n then [f] when length(f) > n then list_transform(range(1, length(f) - n + 2), lambda i: substr(f, i, n)) else [] end) as gram from w, (values (2), (3), (4)) as sizes(n))
select gram, count(*) as n, count(distinct label_id) as rows_with from g group by gram""")
def char_wb_ngrams(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "labels").select("label_id", F.explode(features.char_wb_ngrams(F.col("title"), 2, 4)).alias("gram"))
    per = g.groupBy("gram", "label_id").agg(F.count("*").alias("n"))
    return per.groupBy("gram").agg(F.sum("n").alias("n"), F.count("*").alias("rows_with"))
