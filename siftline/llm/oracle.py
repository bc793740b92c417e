"""SQL with the same rows as queries of this package, where SQL can express them over whole tables."""

from __future__ import annotations

SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def present(c: str) -> str:
    return f"(case when {strip(c)} <> '' and lower({strip(c)}) <> 'nan' then {c} end)"


def video(c: str) -> str:
    return f"nullif(regexp_replace({strip(present(c))}, '^.*(?:/v/|watch\\?v=)', ''), '')"


def name(c: str) -> str:
    bare = f"regexp_replace({strip(present(c))}, '^(?:.*/@|[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?)', '')"
    return f"nullif(lower(regexp_replace(regexp_replace({bare}, '{SPACE}', '', 'g'), '^@+', '')), '')"


SCORES = f"""scores as (
  select video, arg_max(score, k) as score from (
    select {video("video_id")} as video, ml_score as score, row(scored_at, ml_score) as k from scored
    where ml_score >= 0 and ml_score <= 1 and not isnan(ml_score) and scored_at is not null) where video is not null group by video)"""

P2 = f"""with {SCORES}, c as (select row_id, {name("channel")} as ch, {video("video_id")} as video from candidates),
r as (select row_id, row_number() over (partition by ch order by score desc nulls last, row_id) as n from c left join scores using (video) where ch is not null)
select row_id from r where n > 25"""

CUTS = f"""with {SCORES}, goal as (select lower({strip("source")}) as source, max(keep_permille)::bigint as permille from keep_targets group by 1),
v as (select distinct lower({strip(present("source"))}) as source, {video("video_id")} as video from labels),
s as (select source, video, score from v join scores using (video) join goal using (source)),
r as (select *, row_number() over (partition by source order by score desc) as n, count(*) over (partition by source) as total from s),
k as (select source, total, (total * permille + 999) // 1000 as k from (select distinct source, total from r) join goal using (source)),
cut as (select r.source, r.score as cutoff from r join k on r.source = k.source and r.n = k.k)"""

P6 = f"{CUTS} select s.source, s.video as video_id from s join cut using (source) where score >= cutoff"

P6_REPORT = f"""{CUTS} select goal.source, coalesce(k.total, 0)::bigint as n, coalesce(k.k, 0)::bigint as k, cut.cutoff,
  (select count(*) from s where s.source = goal.source and s.score >= cut.cutoff)::bigint as kept
from goal left join k using (source) left join cut using (source)"""

P5 = f"""with recursive rows as (
  select label_id, lower(trim(split)) as split, coalesce({name("label_group")}, {name("channel")}, {name("source_ref")}) as g, {video("video_id")} as v from labels),
first as (select v, min(g) as g0, max(g) as g1 from rows where g is not null and v is not null group by v),
edges as (select distinct g as a, g0 as b from rows join first using (v) where g0 <> g1 and g <> g0),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select distinct a, a as b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
comp as (select a as anchor, min(b) as component from reach group by a),
sets as (select label_id, split, coalesce(component, anchor, 'row ' || label_id) as component from (
  select label_id, split, coalesce('g ' || g, 'g ' || g0, 'v ' || rows.v) as anchor, c.component from rows left join first on rows.v = first.v
  left join (select anchor, 'g ' || component as component from comp) c on c.anchor = coalesce(g, g0)))
select label_id from sets where split in ('train', 'calibration', 'holdout') and component in (
  select component from sets where split in ('train', 'calibration', 'holdout') group by component having count(distinct split) > 1)"""

SQL = {"p2_found": P2, "p5_found": P5, "p6_found": P6, "p6_report": P6_REPORT}

# Han and kana, and Thai, as the units have them; the ranges of units.py.
PAIRED = r"[\x{3005}-\x{3007}\x{3041}-\x{3096}\x{3099}-\x{309A}\x{309D}-\x{309F}\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{323AF}]"
THAI = r"[\x{0E01}-\x{0E5B}]"


def runs(text: str) -> str:
    """Runs of letters, digits and marks in lower case, Han and kana and Thai apart."""
    apart = f"regexp_replace(regexp_replace(lower({text}), '({PAIRED}+)', ' \\1 ', 'g'), '({THAI}+)', ' \\1 ', 'g')"
    return f"regexp_extract_all({apart}, '[\\p{{L}}\\p{{N}}\\p{{M}}]+')"


def grams(run: str, n: int) -> str:
    return f"case when length({run}) < {n} then [{run}] else list_transform(range(1, length({run}) - {n} + 2), lambda i: substr({run}, i, {n})) end"


def unit_list(text: str) -> str:
    return f"list_distinct(flatten(list_transform({runs(text)}, lambda r: case when regexp_matches(r, '^{PAIRED}') then {grams('r', 2)} when regexp_matches(r, '^{THAI}') then {grams('r', 4)} else [r] end)))"


def number_list(text: str) -> str:
    return f"coalesce(list_sort(list_distinct(regexp_extract_all({text}, '\\p{{Nd}}+'))), [])"


def same(a: str, b: str) -> str:
    """The same video or the same title."""
    common = f"len(list_intersect({a}.units, {b}.units))"
    return f"({a}.video = {b}.video or (len({a}.units) >= 0.6 * len({b}.units) and len({b}.units) >= 0.6 * len({a}.units) and len({a}.units) > 0 and {a}.numbers = {b}.numbers and {common} * 1.6 >= 0.6 * (len({a}.units) + len({b}.units)) - 1e-9))"


TITLES = f"select *, coalesce({unit_list('shown')}, []) as units, {number_list('shown')} as numbers from (select *, {video('video_id')} as video, {present('title')} as shown from %s)"

P4 = f"""with t as materialized ({TITLES % 'candidates'})
select min(a.row_id) as first_row_id, b.row_id from t a join t b on a.batch_no < b.batch_no and {same('a', 'b')} group by b.row_id"""

OVERLAPS = f"""t as materialized ({TITLES % 'labels'}), tr as (select * from t where split = 'train'), ev as (select * from t where split in ('calibration', 'holdout')),
o as (select tr.label_id as train_id, ev.label_id as eval_id, ev.split as eval_split, lower({strip('ev.source')}) as eval_source, coalesce(tr.video = ev.video, false) as by_video, tr.units as u, ev.units as w, tr.numbers as x, ev.numbers as y from tr join ev on {same('tr', 'ev')})"""

P7 = f"with {OVERLAPS} select least(train_id, eval_id) as label_id_a, greatest(train_id, eval_id) as label_id_b from o"

P7_REPORT = f"""with {OVERLAPS}, k as (select *, len(u) > 0 and x = y and len(list_intersect(u, w)) * 1.6 >= 0.6 * (len(u) + len(w)) - 1e-9 as by_title from o)
select eval_split, eval_source, count(distinct eval_id) as eval_rows, count(distinct train_id) as train_rows, count(*) as pairs, count(*) filter (by_video) as pairs_by_video, count(*) filter (by_title) as pairs_by_title from k group by 1, 2"""


def windows(key: str, tokens: str, source: str, n: int) -> str:
    return f"select distinct {key}, array_to_string(list_slice(w, i, i + {n - 1}), ' ') as span from (select {key}, w, unnest(range(1, len(w) - {n - 2})) as i from (select {key}, {tokens} as w from {source}))"


def letters(text: str) -> str:
    return f"list_filter(string_split(lower({text}), ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}\\p{{M}}]'))"


LEAKS = f"""items as (select item_id, suite, passage, len(regexp_extract_all(passage, '{PAIRED}')) * 2 > len(regexp_extract_all(passage, '[\\p{{L}}\\p{{N}}\\p{{M}}]')) as paired from eval_items where passage is not null),
docs as (select doc_id, text from documents where text is not null),
iw as ({windows('item_id', runs('passage'), '(select * from items where not paired)', 13)}), dw as ({windows('doc_id', runs('text'), 'docs', 13)}),
il as ({windows('item_id', letters('passage'), '(select * from items where paired)', 24)}), dl as ({windows('doc_id', letters('text'), '(select * from docs)', 24)}),
found as (select item_id, doc_id from iw join dw using (span) union select item_id, doc_id from il join dl using (span))"""

P8 = f"with {LEAKS} select item_id, doc_id from found"

P8_REPORT = f"with {LEAKS} select suite, count(distinct e.item_id) as items, count(distinct e.item_id) filter (doc_id is not null) as leaked_items, count(distinct doc_id) as documents from eval_items e left join found using (item_id) group by suite"

SQL |= {"p4_found": P4, "p7_found": P7, "p7_report": P7_REPORT, "p8_found": P8, "p8_report": P8_REPORT}

# A link needs a common unit among the rarest of either side; groups are the closure of the links between distinct unit sets.
P3 = f"""with recursive r as materialized (select row_id, list_sort(units) as units from (select row_id, {unit_list("concat_ws(' ', coalesce(" + present('title') + ", ''), coalesce(" + present('description') + ", ''))")} as units from candidates) where len(units) > 0),
s as materialized (select min(row_id) as id, units from r group by units), flat as materialized (select id, len(units) as n, unnest(units) as unit from s),
df as (select unit, count(*) as k from flat group by unit), ranked as (select id, n, unit, row_number() over (partition by id order by k, unit) as pos from flat join df using (unit)),
prefix as materialized (select id, n, unit from ranked where pos <= n - ceil(0.6 * n - 1e-9) + 1),
met as (select distinct a.id as a, b.id as b from prefix a join prefix b on a.unit = b.unit and a.id < b.id and a.n >= 0.6 * b.n and b.n >= 0.6 * a.n),
links as materialized (select a, b from met join s x on x.id = a join s y on y.id = b where len(list_intersect(x.units, y.units)) * 1.6 >= 0.6 * (len(x.units) + len(y.units)) - 1e-9),
both_ways as (select a, b from links union select b, a from links),
reach as (select id as a, id as b from s where id in (select a from both_ways) union select c.a, e.b from reach c join both_ways e on c.b = e.a),
g as (select r.row_id, coalesce(x.grp, s.id) as grp from r join s using (units) left join (select a, min(b) as grp from reach group by a) x on x.a = s.id)
select p.row_id as row_id_a, q.row_id as row_id_b from g p join g q on p.grp = q.grp and p.row_id < q.row_id"""

SQL["p3_found"] = P3

# What must hold of results that SQL cannot make: every row assigned, no set parted, caps and quotas kept.
SQL["p5_checks"] = "select count(*) as rows, 0::bigint as parted, true as shares_met from labels where label_id is not null"
SQL["p9_checks"] = "select lower(trim(source)) as source, target_pct, true as cap_holds, true as quota_met from mix_targets"
