"""Column functions, labels, rules, joins, samples, metrics and thresholds on small tables with known results."""

import pytest
from pyspark.sql import functions as F

from siftline.functions import keys, labels, scoring, text
from siftline.operators import dedup, joins, metrics, nested, rules, sampling, tags, thresholds


def column(spark, values, expr, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema).select(expr).collect()]


def test_keys(spark):
    assert column(spark, ["a", " ", None, "NaN", "nan ", "　x"], keys.strip(keys.present("x"))) == ["a", None, None, None, None, "x"]
    assert column(spark, [" abc ", "https://v.example/watch?v=abc", "v.example/v/abc", "nan", None, ""], keys.bare_video_id("x")) == ["abc", "abc", "abc", None, None, None]
    assert len(set(column(spark, ["Foo & Sons", "https://v.example/@foo&sons", "@FOO&sons", " foo  &  Sons "], keys.name_key("x")))) == 1


def test_build_text(spark):
    df = spark.createDataFrame([("A  b", "ch", "x" * 900, "-foo* bar", "9")], "title string, channel string, description string, keyword string, duration_seconds string")
    row = df.select(text.title_with("channel").alias("a"), text.title_and_description().alias("b"), text.title_keyword_tokens().alias("c"), text.title_keyword_or_channel().alias("d")).first()
    assert row.a == "A b ch" and row.b == "A b " + "x" * 800 and row.c == "A b bar" and row.d == "A b -foo* bar"
    film = spark.createDataFrame([("Film (1999)", None, "")], "title string, keyword string, channel string").select(text.title_keyword_tokens(), text.title_keyword_or_channel()).first()
    assert film[0] == "Film (1999) FILM_YEAR_TOKEN HAS_YEAR_TOKEN" and film[1] == "Film (1999)"
    assert text.parse_fields("title, channel") == ["title", "channel"]
    with pytest.raises(ValueError):
        text.parse_fields(" , ")


def test_features(spark):
    df = spark.createDataFrame([("A Podcast show", None, "120"), (None, "x" * 21, "nan"), (" ", "", "bad")], "title string, description string, duration_seconds string")
    rows = df.select(*text.length_features(), *text.word_flags("title", ["podcast", "how"])).collect()
    assert [(r.title_wc, r.has_desc, r.duration_min, r.has_podcast, r.has_how) for r in rows] == [(3, 0, 2.0, 1, 0), (0, 1, 0.0, 0, 0), (0, 0, 0.0, 0, 0)]
    assert abs(rows[1].duration_log - 6.39859) < 1e-4


def test_labels(spark):
    assert column(spark, ["T", "pass", "F 无法播放", "fail", "U", None], labels.strict_label("x")) == ["T", "T", None, "F", None, None]
    assert column(spark, ["合格", "T", "fail", "未知", None], labels.human_label("x")) == ["pass", "pass", "fail", None, None]
    assert column(spark, ["True", "f", "U", "", None], labels.bool_label("x")) == [True, False, None, None, None]
    assert column(spark, ["the answer is t.", "F", "TF", None, "maybe"], labels.answer("x")) == ["T", "F", "ERROR", "ERROR", "ERROR"]


def test_loader_precedence(spark):
    one = spark.createDataFrame([("a", "T", 1), ("b", "F", 2), ("e", "ERROR", 3)], "video_id string, qc_text_result string, row_ordinal int")
    two = spark.createDataFrame([("a", "F", 1), ("c", "u", 2)], "video_id string, qc_text_result string, row_ordinal int")
    got = labels.Loader(["qc_text_result"]).load([("run01", one), ("run02", two)])
    assert sorted((r.video_id, r.label_kind, r.y, r.qc_round) for r in got.collect()) == [("a", "T", 1, "run01"), ("b", "F", 0, "run01"), ("c", "U", 1, "run02")]
    both = spark.createDataFrame([("a", "t", "F"), ("b", None, "T")], "video_id string, qc_result string, qc_text_result string")
    human = labels.Loader(["qc_result", "qc_text_result"], kept=("T", "F"), needs_value=True).load([("x", both)])
    assert [(r.video_id, r.label_kind) for r in human.collect()] == [("a", "T")]
    with pytest.raises(ValueError):
        labels.Loader(["qc_result"]).load([("x", one)])


def test_rules(spark):
    df = spark.createDataFrame([("Bad game", "c"), ("fine", "Blocked"), ("fine", "blocked too"), (None, None)], "title string, channel string")
    sections = [rules.Section("title_blacklist", "title", ["game"]), rules.Section("channel_blacklist", "channel", ["blocked"], exact=True), rules.Section("none", "title", [])]
    a = rules.attribute(df, sections)
    assert [r.drop_step for r in a.collect()] == ["title_blacklist", "channel_blacklist", None, None]
    assert a.where("decision = 'keep'").count() + a.where("decision = 'drop'").count() == df.count()
    with pytest.raises(RuntimeError):
        rules.hit_counts(df, "title", ["(bad"])
    assert rules.order_by_hits(["a", "b", "c"], {"b": 5, "c": 9}) == ["c", "b", "a"]
    assert df.where(F.lit("x").rlike(rules.alternation([]))).count() == 0
    q = spark.createDataFrame([("loud party", "F")] * 3 + [("calm talk", "T"), ("loud talk", "U")], "title string, label string")
    s = {r.pattern: r.addable for r in rules.pattern_scores(q, "title", "label", ["loud party", "loud", "calm"]).collect()}
    assert s == {"loud party": True, "loud": False, "calm": False}
    assert [r.ngram for r in rules.mine_ngrams(q, "title", "label").collect()] == ["loud party"]
    r = rules.route(spark.createDataFrame([("cartoon of hair",), ("hair and nails",), ("else",)], "title string"), {"anime": "cartoon"}, {"nails": "nail", "hair": "hair"}).collect()
    assert [(x.stage, x.industry_primary) for x in r] == [("l1_drop", None), ("candidate", "nails"), ("unrouted", None)]
    reason = rules.prefilter_reason(F.col("d"), F.col("c"), F.col("t"), ["bad"], 60, 7200, ["music"])
    got = spark.createDataFrame([(30, "x", "y"), (25200, "x", "y"), (90, "BAD", "y"), (90, "x", "Music!"), (90, "x", "y")], "d int, c string, t string").select(reason).collect()
    assert [g[0] for g in got] == ["l0:too_short:30s", "l0:too_long:25200s", "l0:channel_blacklist", "l0:title:music", None]


def test_scoring(spark):
    assert column(spark, [0.05, 0.92, 0.40, None], scoring.action("x", 0.15, 0.85), "x double") == ["drop", "keep_candidate", "uncertain", "uncertain"]
    assert column(spark, [0.10, 0.35, 0.80, None], scoring.confidence_band("x"), "x double") == ["high", "mid", "low", None]
    assert column(spark, [244, 220, 0], scoring.wilson_lower("x", F.when(F.col("x") > 0, 270).otherwise(0)), "x int")[0] > 0.85
    got = column(spark, [100, 4, 0], scoring.sample_indices("x", 6), "x int")
    assert got[0] == [8, 25, 41, 58, 75, 91] and got[1] == [0, 1, 2, 3] and got[2] == []
    assert column(spark, [0.9], scoring.contrast("x", F.lit(0.1)), "x double")[0] > 0.99


def test_nested(spark):
    df = spark.createDataFrame(
        [(1, [("sb0", "storyboard", 90, None, "none", "none", None), ("137", None, 1080, None, "avc1", "mp4a", None)]), (2, [("x", None, None, "1080x1920", "avc1", None, None)]), (3, [("x", "480p", None, None, "avc1", None, None)]), (4, [("140", None, None, None, "none", "mp4a", None)]), (5, []), (6, None)],
        f"id int, formats {nested.FORMATS}",
    )
    got = [(r.h, r.s) for r in df.select("id", nested.max_height(F.col("formats")).alias("h"), nested.missing_height_status(F.col("formats")).alias("s")).orderBy("id").collect()]
    assert got == [(1080, None), (1920, None), (480, None), (None, "NO_HEIGHT"), (None, "EMPTY_FORMATS"), (None, "EMPTY_FORMATS")]
    urls = spark.createDataFrame([([("a",), (None,), (" ",), ("b",)],)], "f array<struct<url:string>>").select(nested.fragment_urls(F.col("f"))).first()[0]
    assert urls == ["a", "b"]
    box = spark.range(1).select(nested.tile_box(F.lit(7), 5, 160, 90).alias("b")).first().b
    assert (box.x0, box.y0, box.x1, box.y1) == (320, 90, 480, 180)


def test_joins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("x", "p"), ("z", "q")], "k string, w string")
    assert joins.one_to_one(a, b, ["k"]).count() == 1
    with pytest.raises(ValueError):
        joins.one_to_one(a.union(a), b, ["k"])
    assert [r.w for r in joins.lookup(a, b, "k", "w", "none").orderBy("v").collect()] == ["p", "none", "none"]
    assert joins.unknown(a, b, "k").count() == 2 and joins.known(a, b, "k").count() == 1
    with pytest.raises(ValueError):
        joins.require_subset(b, a, "k")
    g = joins.gather(["z", "m", "x"], b, "k").collect()
    assert [(r.k, r.found) for r in g] == [("z", True), ("m", False), ("x", True)]
    side = spark.createDataFrame([("x", "new"), ("y", "")], "k string, s string")
    main = spark.createDataFrame([("x", "old"), ("y", "keep"), ("w", None)], "k string, s string")
    assert {(r.k, r.s) for r in joins.side_merge(main, side, "k", ["s"]).collect()} == {("x", "new"), ("y", "keep"), ("w", None)}
    e = joins.enrich(spark.createDataFrame([("x", "t1"), ("n", "CN t"), ("m", "t")], "k string, title string"), b.withColumnRenamed("w", "region"), "k", "region", F.when(F.col("title").startswith("CN"), "CN"))
    assert {(r.k, r.region, r.label_source) for r in e.collect()} == {("x", "p", "ref_join"), ("n", "CN", "title_rule"), ("m", None, "yt_only")}


def test_dedup(spark):
    df = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first"), (None, 3, "none"), (None, 4, "none2")], "k string, o int, v string")
    assert {r.v for r in dedup.keep_by_order(df, ["k"], ["o"]).collect()} == {"first", "none"}
    assert {r.v for r in dedup.keep_by_order(df, ["k"], ["o"], last=True).collect()} == {"second", "none2"}
    assert {r.v for r in dedup.first_value_per_key(df, ["k"], "o", ["v"]).collect()} == {"first", "none"}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [("F", 0.05), ("F", 0.10), ("F", 0.15), ("F", 0.2), ("F", 0.3), ("U", 0.35), ("T", 0.4), ("T", 0.6), ("T", 0.8), ("F", 0.7), (None, 0.1), ("T", None)]
    return spark.createDataFrame([(i, k, s, 3600.0) for i, (k, s) in enumerate(rows)], "id int, kind string, score double, duration_seconds double").persist()


def test_metrics(judged):
    m = metrics.threshold_metrics(judged, 0.33).first()
    assert (m.n, m.n_drop, m.f_caught, m.t_hurt, m.n_f) == (10, 5, 5, 0, 6) and m.precision == 1.0
    assert metrics.threshold_metrics(judged, 0.0).first().precision == 0.0 and metrics.threshold_metrics(judged, 0.0, 1.0).first().precision == 1.0
    assert abs(metrics.roc_auc(judged).first().auc - 21 / 24) < 1e-9
    a = metrics.action_metrics(judged, 0.33, 0.75).first()
    assert (a.keep_n, a.keep_precision, a.drop_n, a.drop_overturn) == (1, 1.0, 5, 0.0)
    empty = metrics.action_metrics(judged, -1.0, 2.0).first()
    assert (empty.keep_precision, empty.drop_overturn) == (0.0, 1.0)
    top = {r.percent: (r.k, r.precision) for r in metrics.top_share_metrics(judged, [1, 25, 30]).collect()}
    assert top == {1.0: (1, 1.0), 25.0: (2, 0.5), 30.0: (3, 2 / 3)}
    none = judged.limit(0)
    assert metrics.roc_auc(none).first().auc is None and metrics.average_precision(none).first().ap is None
    w = {r.kind: r.weight for r in metrics.source_weights(judged.where("kind is not null"), "kind").collect()}
    assert abs(w["U"] - 11 / 3) < 1e-9


def test_thresholds(judged):
    s = {r.threshold: r for r in thresholds.sweep(judged, thresholds.grid(1, 99)).collect()}
    assert len(s) == 99 and s[0.05].n_drop == 0 and s[0.06].n_drop == 1 and s[0.99].n_drop == 10
    p = thresholds.STRICT.pick(judged).first()
    assert p.met and p.t_hurt == 0 and p.precision == 1.0 and 0.3 < p.threshold <= 0.35
    v = thresholds.VETO.pick(judged).first()
    assert v.met and v.f_recall >= 0.8 and v.keep_rate >= 0.08
    assert [(r.threshold, r.met) for r in thresholds.CONSERVATIVE.pick(judged.where("kind = 'T'")).collect()] == [(0.03, False)]
    assert {r.profile for r in thresholds.profiles(judged).collect()} == {"strict", "mid", "loose"}
    a = thresholds.action_thresholds(judged, 0.6, 0.1, 2, 3).first()
    assert a.keep_met and a.drop_met and a.drop_threshold == 0.35


def test_lots(spark):
    lot = spark.createDataFrame([(f"v{i}",) for i in range(5)], "video_id string")
    ok = spark.createDataFrame([("v0", "pass"), ("v1", "pass"), ("v2", "pass")], "video_id string, verdict string")
    assert metrics.lot_decision(lot, ok, 0.85).first().decision == "accept"
    bad = spark.createDataFrame([("v0", "pass"), ("v1", "fail"), ("v2", "fail")], "video_id string, verdict string")
    assert metrics.lot_decision(lot, bad, 0.85).first().decision == "reject"
    with pytest.raises(ValueError):
        metrics.lot_decision(lot, spark.createDataFrame([("zz", "pass")], "video_id string, verdict string"), 0.85)


def test_samples(spark):
    df = spark.range(500).select("id", (F.col("id") % 40).cast("string").alias("channel"), (F.col("id") * 7 % 500).cast("double").alias("s"), (F.col("id") / 500).alias("p")).withColumn("action", F.when(F.col("p") < 0.2, "drop").when(F.col("p") > 0.8, "keep_candidate").otherwise("uncertain"))
    a = [r.id for r in sampling.hash_sample(df, 20, 1, "id").collect()]
    assert a == [r.id for r in sampling.hash_sample(df.repartition(5), 20, 1, "id").collect()] and a != [r.id for r in sampling.hash_sample(df, 20, 2, "id").collect()]
    blind = sampling.spread_sample(df, 10, 3, "id", "channel", "s").collect()
    assert len(blind) == 10 and len({r.channel for r in blind}) == 10 and len({r.sample_stratum for r in blind}) >= 4
    v = df.withColumn("vec", F.array(F.col("p"), 1 - F.col("p")))
    routes = sampling.active_routes(v, "p", "action", {"boundary": 6, "diverse_keep": 5, "drop_overturn": 4}, 1, "id", "vec").collect()
    assert sorted({(r.route, sum(x.route == r.route for x in routes)) for r in routes}) == [("boundary", 6), ("diverse_keep", 5), ("drop_overturn", 4)]
    assert len({r.id for r in routes}) == 15
    parts = df.select("channel", sampling.group_split(F.col("channel"), {"train": 6, "calibration": 2, "holdout": 2}, 1).alias("s")).groupBy("channel").agg(F.countDistinct("s").alias("n"))
    assert parts.where("n > 1").count() == 0


def test_tags(spark):
    registry = spark.createDataFrame([("foo", "甲类", "active", ["al"], None), ("bar_old", "乙", "deprecated", None, "foo")], "id string, label_zh string, status string, aliases array<string>, maps_to string")
    df = spark.createDataFrame([(1, "甲类|bar_old, zzz"), (2, None), (3, "AL")], "k int, t string")
    assert {(r.k, r.tag) for r in tags.normalise(df, "k", "t", registry).collect()} == {(1, "foo"), (1, "provisional:zzz"), (3, "foo")}
    assert {(r.k, r.tag) for r in tags.normalise(df, "k", "t", registry, "").collect()} == {(1, "foo"), (3, "foo")}
    p = spark.createDataFrame([(i, "foo", "text", "s") for i in range(5)], "k int, reject_tag string, modality string, propose_source string")
    v = p.limit(1).withColumn("reject_action", F.lit("confirm"))
    m = tags.metrics(p, v).first()
    assert (m.n_proposed, m.n_validated, m.trust_status, m.suggestion) == (5, 1, "untrusted", "collect_more_validation")
    assert tags.merge_proposals(p, p, "k").count() == 5
    b = spark.createDataFrame([(1, 5), (2, 0), (3, 0)], "o int, h int")
    assert tags.boundary(b, "o", "h").first().boundary and not tags.boundary(b.where("o < 3"), "o", "h").first().boundary


def test_direct_metrics_and_hours(spark, judged):
    p = judged.withColumn("p", F.when(F.col("score") >= 0.6, "T").when(F.col("score") < 0.25, "F").otherwise("U"))
    m = metrics.direct_metrics(p, "p").first()
    # kinds at or over 0.6: T, T, F; under 0.25: F four times; the row without a score predicts U, the one without a label counts nowhere
    assert (m.n, m.valid, m.predicted_t, m.predicted_f) == (11, 7, 3, 4) and abs(m.precision_t - 2 / 3) < 1e-9 and m.overturn_f == 0.0 and abs(m.accuracy - 6 / 7) < 1e-9
    none = metrics.direct_metrics(p.limit(0), "p").first()
    assert (none.n, none.coverage, none.precision_t, none.overturn_f, none.accuracy) == (0, 0.0, 0.0, 1.0, 0.0)
    top = {r.percent: (r.hours, r.hours_share) for r in metrics.top_share_metrics(judged, [30]).collect()}
    assert top == {30.0: (3.0, 0.3)}
    tied = spark.createDataFrame([(i, "T" if i < 3 else "F", 0.5, float(i)) for i in range(10)], "id int, kind string, score double, duration_seconds double")
    r = metrics.top_share_metrics(tied, [20, 50]).orderBy("percent").collect()
    assert [(x.k, x.precision, round(x.hours * 3600)) for x in r] == [(2, 1.0, 1), (5, 0.6, 10)]
    q = metrics.projection(tied, 2.0, 4, 0.5).first()
    assert (q.rows, round(q.hours * 3600), round(q.step_hours * 3600), round(q.keep_hours * 3600)) == (10, 45, 5, 22)
    b = metrics.status_board(spark.createDataFrame([("T",), (" f",), ("error",), ("",), (None,), ("x",)], "s string"), "s").first()
    assert (b.n_t, b.n_f, b.n_error, b.pending, b.done) == (1, 1, 1, 2, 4)


def test_splits_with_groups_review_and_hold_out(spark):
    rows = [(i, f"c{i // 2}" if i < 40 else (None, "", "nan")[i % 3], f"ref{i // 4}" if i < 60 else None) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, channel string, source_ref string")
    bad = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    got = sampling.labelled_split(df, ["channel", "source_ref"], "id", {"train": 0.6, "calibration": 0.2, "holdout": 0.2}, 42, bad).collect()
    assert len(got) == 80 and [r.split for r in got if r.id == 1] == ["review"]
    groups = {}
    for r in got:
        assert r.label_group == (r.channel if r.id < 40 else r.source_ref if r.id < 60 else f"row {r.id}")
        if r.id != 1:
            groups.setdefault(r.label_group, set()).add(r.split)
    assert all(len(s) == 1 for s in groups.values()) and {x for s in groups.values() for x in s} == {"train", "calibration", "holdout"}
    h = spark.range(3000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    held = {r.y: (r.n, r.h) for r in sampling.hold_out(h, "id", "y", 0.2, 1).groupBy("y").agg(F.count("*").alias("n"), F.sum(F.col("held").cast("int")).alias("h")).collect()}
    assert all(abs(h - 0.2 * n) <= 64 for n, h in held.values())
    blind = sampling.spread_sample(spark.range(30).select("id", F.col("id").alias("channel"), F.col("id").cast("double").alias("s")), 10, 7, "id", "channel", "s", exclude=spark.range(2)).collect()
    assert len(blind) == 10 and not {r.id for r in blind} & {0, 1}


def test_k_center_against_brute_force(spark):
    import random

    rng = random.Random(4)
    x = [[rng.random(), rng.random()] for _ in range(40)]
    got = {r.id for r in sampling.k_center(spark.createDataFrame([*enumerate(x), (99, None)], "id int, v array<double>"), "id", "v", 6).collect()}
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(x[a], x[b], strict=True))
    chosen = [0]
    while len(chosen) < 6:
        chosen.append(max(range(40), key=lambda i: min(far(i, c) for c in chosen)))
    assert got == set(chosen)


def test_gather_is_strict_on_request(spark):
    store = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    assert [r.v for r in joins.gather(["a", "a"], store, "k", strict=True).collect()] == [1, 1]
    for ids in (["a", "zz"], ["b"]):
        with pytest.raises(ValueError):
            joins.gather(ids, store, "k", strict=True)


def test_definitions_tags_rescues_and_classes(spark):
    rows = spark.createDataFrame([("a", "ta", "old"), ("b", "tb", "x"), ("c", "tc", "y"), ("d", "td", None)], "video_id string, title string, is_hd string")
    d = spark.createDataFrame([("a", "1", "hd"), ("b", "0", "sd"), ("c", "", None)], "video_id string, is_hd string, status string")
    kept, dropped = joins.by_definition(rows, d, "video_id", "is_hd")
    assert [r.asDict() for r in kept.collect()] == [{"video_id": "a", "title": "ta"}] and {r.video_id for r in dropped.collect()} == {"b", "c", "d"}
    pics = spark.createDataFrame([("T", None), ("F", None), ("f", "looks like 动漫"), (None, "动漫")], "v string, e string")
    assert [r[0] for r in pics.select(tags.picture_tag("v", "e", {"动漫": "drawn"})).collect()] == [None, "provisional:thumb_fail", "drawn", None]
    t = spark.createDataFrame([("Picking ripe mango",), ("How to pick mango",), ("Picking",), (None,)], "title string")
    assert [r[0] for r in t.select(rules.rescued("title", ["pick"], ["mango"], ["how to"])).collect()] == [True, False, False, False]
    assert [r[0] for r in t.select(rules.rescued("title", [], ["mango"], [])).collect()] == [False] * 4
    name, source = rules.classify(F.col("title"), {"how": "how to", "pick": "pick"})
    assert [tuple(r) for r in t.select(name, source).collect()] == [("pick", "title_rule"), ("how", "title_rule"), ("pick", "title_rule"), (None, "")]
