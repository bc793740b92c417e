"""Vectors, features, models, streams, sources, stages, and the driver's entry."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.operators import features, models, vectors
from siftline.plans import stages
from siftline.sources import readers, remote
from siftline.streaming import inbox


def test_margins_and_decisions(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], "id int, v array<float>")
    m = vectors.margins(df, "v", {"q": ([1.0, 0.0], [0.0, 1.0])})
    got = [r.q for r in m.orderBy("id").collect()]
    assert got[0] > 0 > got[1] and got[2] is None
    d = vectors.decide(m.withColumn("ok", F.col("id") < 3), {"q": 0.1}, ["q"], "ok")
    assert [r.clip_decision for r in d.orderBy("id").collect()] == ["clip_pass", "clip_fail", "no_thumb"]


def test_nearest_in_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(70, 8))
    df = spark.createDataFrame([(i, [float(a) for a in v], str(i % 2)) for i, v in enumerate(x)], "id bigint, vector array<float>, group string")
    x = x.astype(np.float32).astype(np.float64)
    sim = x @ x.T
    np.fill_diagonal(sim, -9)
    for block in (1000, 20):
        got = {(r.id, r["rank"]): r.match_id for r in vectors.nearest(df, df, 3, skip_self=True, block=block).collect()}
        assert all(got[i, k + 1] == j for i in range(70) for k, j in enumerate(np.argsort(-sim[i])[:3]))
    assert vectors.nearest(df, df.limit(0), 3).count() == 0
    loo = vectors.loo_contrast(vectors.nearest(df, df, 1, per_group=True, skip_self=True), "0", "1").collect()
    assert len(loo) == 70 and abs(loo[0].sim_keep - max(sim[loo[0].id][0::2])) < 1e-9


def test_fingerprint_ignores_order(spark):
    a, b = spark.range(100), spark.range(100).repartition(7)
    assert vectors.fingerprint(a, "id").first() == vectors.fingerprint(b, "id").first() != vectors.fingerprint(spark.range(99), "id").first()
    assert vectors.missing_ids(spark.range(5), spark.range(3), "id").count() == 2


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "aa bb bb"), (2, "aa cc"), (3, None)], "k int, t string")
    got = {(r.k, r.term): r.weight for r in features.tfidf(df, "k", features.tokens("t")).collect()}
    idf = lambda d: np.log(4 / (1 + d)) + 1
    a, b = idf(2), (1 + np.log(2)) * idf(1)
    assert abs(got[1, "bb"] - b / np.hypot(a, b)) < 1e-9 and set(got) == {(1, "aa"), (1, "bb"), (2, "aa"), (2, "cc")}
    g = spark.createDataFrame([("ab c",)], "t string").select(features.char_wb_ngrams(F.col("t"), 2, 3)).first()[0]
    assert sorted(g) == sorted([" a", "ab", "b ", " ab", "ab ", " c", "c ", " c "])
    w = spark.createDataFrame([(["x", "y", "z"],)], "w array<string>").select(features.word_ngrams(F.col("w"), 1, 2)).first()[0]
    assert w == ["x", "y", "z", "x y", "y z"]


def test_out_of_fold_scores_separate_the_classes(spark):
    rows = [(i, ("good calm talk " if i % 2 else "bad loud noise ") + f"w{i % 5}", i % 2, f"g{i % 12}") for i in range(60)]
    df = models.text_columns(spark.createDataFrame(rows, "id int, title string, y int, g string"), "title")
    got = models.out_of_fold(df, "id", "y", models.logistic_pipeline, 2).collect()
    assert len(got) == 60 and min(r.score for r in got if r.y) > max(r.score for r in got if not r.y)
    with pytest.raises(ValueError):
        models.out_of_fold(df.where("y = 1"), "id", "y", models.logistic_pipeline)
    f = models.group_folds(df, "g", "y", 3)
    assert f.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0 and f.select("fold").distinct().count() == 3
    assert models.choose_candidate(0.8, 0.9, True, True) == "mixed" and models.choose_candidate(0.9, 0.9, True, True) == "base" and models.choose_candidate(0.8, 0.9, True, False) == "base"
    ok, reasons = models.go_no_go({"auc": 0.9, "keep_n": 60, "keep_precision": 0.95, "drop_n": 10, "drop_overturn": 0.01})
    assert not ok and reasons == ["drop_n"]


def test_the_fit_converges(spark, sf):
    """AUC and log loss of the production fit equal those of a much longer one, and it stops before its limit."""
    from siftline.operators import metrics
    from siftline.plans.q_metrics import _labelled_titles

    df = models.balanced(models.text_columns(_labelled_titles(spark, sf), "title")).coalesce(1).persist()
    n = df.agg(F.sum("weight")).first()[0]
    got = []
    for tolerance, iterations in ((1e-6, 2000), (1e-9, 10_000)):
        model = models.text_pipeline(models.logistic(n, 1.0, iterations, tolerance)).fit(df)
        scored = models.probability(model.transform(df)).select("id", "y", "kind", "score").persist()
        got.append((metrics.roc_auc(scored.select("kind", "score")).first().auc, models.log_loss(scored).first().log_loss))
        assert models.iterations_used(model) < iterations
    assert abs(got[0][0] - got[1][0]) < 1e-3 and abs(got[0][1] - got[1][1]) < 1e-4
    assert models.logistic(1.0).getMaxIter() == 2000 and models.logistic(1.0).getTol() <= 1e-6


def test_terms_fusion_and_stored_models(spark, tmp_path):
    rows = [(i, ("good calm talk " if i % 2 else "bad loud noise ") + f"w{i % 5}", i % 2, None if i % 7 == 0 else float(i % 2), f"g{i % 12}") for i in range(60)]
    df = models.balanced(models.text_columns(spark.createDataFrame(rows, "id int, title string, y int, n double, g string"), "title"))
    model = models.text_pipeline(models.logistic(60.0), vocabulary=500).fit(df)
    top = {(r.side, r.term) for r in models.top_terms(model, spark, 3).collect()}
    assert all(any(w in t for w in ("good", "calm", "talk", "goo", "oo", "go", "al", "tal", "ca", "lk")) for s, t in top if s == "positive") and len(top) == 6
    models.save(model, str(tmp_path / "model"))
    models.save(model, str(tmp_path / "model"))
    again = models.load(str(tmp_path / "model"))
    a, b = (models.probability(m.transform(df)).orderBy("id").select("score").collect() for m in (model, again))
    assert a == b
    fused = models.fusion_pipeline(["n"], models.logistic(60.0), 500).fit(df).transform(df).orderBy("id").select("numbers").collect()
    x = np.array([r.numbers[0] for r in fused])
    raw = np.array([np.nan if r[3] is None else r[3] for r in rows])
    raw = np.where(np.isnan(raw), np.sort(raw[~np.isnan(raw)])[(~np.isnan(raw)).sum() // 2 - 1 : (~np.isnan(raw)).sum() // 2 + 1].min(), raw)
    assert abs(x.mean()) < 1e-9 and abs(x.std(ddof=1) - 1) < 1e-9 and len(set(np.round(x, 6))) == len(set(raw))
    idf = models.SmoothIDF("words_tf", "z", 2).fit(model.transform(df))
    tf = model.stages[0].vocabulary
    docs = sum("good" in r[1].split() for r in rows)
    assert abs(idf.getScalingVec()[tf.index("good")] - (np.log(61 / (1 + docs)) + 1)) < 1e-9
    svm = models.calibrated_svm(df.drop("weight"), "id", "y", 2, iterations=20).collect()
    assert min(r.score for r in svm if r.y) > max(r.score for r in svm if not r.y) and all(0 <= r.score <= 1 for r in svm)


def test_group_folds_are_even_and_scored(spark):
    rows = [(i, "good talk" if i % 2 else "bad noise", i % 2, None if i % 50 == 0 else f"g{i % 300 if i >= 200 else 'hot'}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, title string, y int, g string")
    f = models.group_folds(df, "g", "y", 5)
    assert f.count() == 2000 and f.where("fold is null").count() == 0 and f.groupBy("g").agg(F.countDistinct("fold").alias("k")).where("k > 1").count() == 0
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 150
    got = models.out_of_fold(models.text_columns(f.where("id < 300").withColumnRenamed("fold", "f"), "title"), "id", "y", models.logistic_pipeline, 5, fold_col="f").collect()
    assert len(got) == 300 and np.mean([r.score for r in got if r.y]) > np.mean([r.score for r in got if not r.y])


def test_reduction_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 6)) * [5, 3, 2, 1, 1, 1] + 2
    df = spark.createDataFrame([*((i, [float(a) for a in v]) for i, v in enumerate(x)), (99, None)], "id int, v array<double>").repartition(3)
    for centred in (False, True):
        y = x - x.mean(0) if centred else x
        top = np.linalg.svd(y)[2][:2]
        top = top * np.sign(top[np.arange(2), np.abs(top).argmax(1)])[:, None]
        got = {r.id: r.reduced for r in models.reduce(df, "id", "v", 2, centred).collect()}
        assert got.pop(99) is None and np.allclose(np.array([got[i] for i in range(60)]), y @ top.T)
    with pytest.raises(ValueError):
        models.components(df, "v", 7)
    with pytest.raises(ValueError):
        models.components(df.limit(0), "v", 1)


def test_prototypes_from_few_picks(spark):
    rows = [(0, [1.0, 0.0], "T"), (1, [0.0, 1.0], "F"), (2, [0.9, 0.1], None), (3, None, "T"), (4, [0.1, 0.9], None)]
    df = spark.createDataFrame(rows, "id int, v array<double>, k string")
    got = {r.id: r.score for r in vectors.prototype_scores(df, "id", "v", F.col("k") == "T", F.col("k") == "F").collect()}
    assert got[2] > 0.5 > got[4] and got[3] is None
    with pytest.raises(ValueError):
        vectors.prototype_scores(df, "id", "v", F.col("k") == "T", F.col("k") == "none")


def test_pictures(spark):
    from siftline.operators import pictures

    smooth = np.tile(np.linspace(60, 180, 64), (48, 1)).astype(np.uint8)
    poster = smooth.copy()
    poster[10:40:4, 8:56] = 255
    poster[12:40:4, 8:56] = 0
    rows = [("a", smooth.tobytes(), 64, 48), ("b", poster.tobytes(), 64, 48), ("c", np.repeat(poster, 3).tobytes(), 64, 48), ("d", b"xx", 64, 48), ("e", None, None, None)]
    got = {r.k: r for r in pictures.text_heaviness(spark.createDataFrame([(k, bytearray(d) if d else None, w, h) for k, d, w, h in rows], "k string, pixels binary, width int, height int"), "k").collect()}
    assert got["b"].stroke_high_ratio > got["a"].stroke_high_ratio and got["b"].lap_std > got["a"].lap_std and got["b"].text_score > got["a"].text_score
    assert abs(got["c"].text_score - got["b"].text_score) < 1e-9 and got["d"].text_score is None and got["e"].text_score is None
    assert pictures.middle_tile(5, 5, 25) == 12 and pictures.middle_tile(5, 5, 9) == 0
    sheet = np.arange(48 * 64).reshape(48, 64)
    assert pictures.crop(sheet, 3, 2, 32, 24).tolist() == sheet[24:, 32:].tolist() and pictures.crop(sheet, 4, 2, 32, 24) is None


def test_fetched_files_are_kept(spark, tmp_path):
    cache = str(tmp_path / "cache")

    def fetch(k):
        if k == "bad":
            raise RuntimeError("404 not found")
        return None if k == "none" else b"x" * (10 if k == "tiny" else 2000)

    df = spark.createDataFrame([("a",), ("a",), ("bad",), ("none",), ("tiny",), (None,), ("../up",)], "id string")
    got = {r.id: (r.status, r.length) for r in remote.fetch_cached(df, "id", fetch, cache).collect()}
    assert got == {"a": ("fetched", 2000), "bad": ("permanent", None), "none": ("small", None), "tiny": ("small", 10)}
    assert remote.fetch_cached(df, "id", fetch, cache).where("id = 'a'").first().status == "cached" and os.listdir(cache) == ["a.jpg"]


def test_matrix_files_and_digests(spark, tmp_path):
    import hashlib

    df = spark.createDataFrame([(i, [float(i), 0.5]) for i in range(7)] + [(9, None)], "id int, v array<float>").repartition(2)
    assert readers.export_npy(df, "id", "v", str(tmp_path / "npy")) == 7
    back = {}
    for f in sorted((tmp_path / "npy").glob("*.npy")):
        back.update(zip(json.loads(f.with_suffix(".ids.json").read_text()), np.load(f).tolist(), strict=True))
    assert back == {str(i): [float(i), 0.5] for i in range(7)}
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a b.bin").write_bytes(b"q" * 3_000_000)
    r = stages.sha256_of(spark, str(tmp_path / "f")).first()
    assert r.sha256 == hashlib.sha256(b"q" * 3_000_000).hexdigest() and r.length == 3_000_000
    p = tmp_path / "one.csv"
    p.write_text("a,b\n1,2\n3,4\n")
    assert readers.read_csv(spark, str(p), line_breaks=False).count() == 2


def test_verdicts_and_reflux(spark):
    df = spark.createDataFrame([("a", "T", "x"), ("b", "F", "y"), ("c", "合格", "z"), ("d", "未知", "w"), ("c", "fail", "z"), (None, "F", "q")], "video_id string, qc string, title string")
    parts = {k: v.collect() for k, v in stages.ingest_verdicts(df, "qc").items()}
    assert {k: len(v) for k, v in parts.items()} == {"labeled": 5, "pass": 2, "fail": 3, "train_export": 3, "reject_validated": 3}
    assert {(r.video_id, r.y, r.title) for r in parts["train_export"]} == {("a", 1, "x"), ("b", 0, "y"), ("c", 0, "z")}
    d = spark.createDataFrame([(f"v{i % 50}", "x") for i in range(100)], "video_id string, title string")
    one, two = ([r.video_id for r in stages.reflux_sample(d.repartition(k), 20, 1).collect()] for k in (1, 3))
    assert one == two and len(set(one)) == 20 and stages.reflux_sample(d, 500, 1).count() == 50


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    src, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    src.mkdir()
    (src / "a.csv").write_text('video_id,title\na,"x, ""q""\nline"\nb,y\n', "utf-8-sig")
    schema = "video_id string, title string"
    run = lambda: inbox.run_batches(inbox.read_inbox(spark, str(src), schema), lambda df, i: df.write.mode("append").parquet(out), mark).awaitTermination()
    run()
    (src / "b.csv").write_text("video_id,title\nc,z\n")
    run()
    assert sorted((r.video_id, r.title) for r in spark.read.parquet(out).collect()) == [("a", 'x, "q"\nline'), ("b", "y"), ("c", "z")]


def test_breaker_and_sessions(spark):
    seq = [(1, i, s) for i, s in enumerate("xxxxo" + "xxxxx" + "oxxxxxxxxo")]
    df = spark.createDataFrame(seq, "u int, t int, s string").withColumn("bad", F.col("s") == "x")
    got = [r.tripped for r in inbox.rolling_breaker(df, "u", ["t"], F.col("bad")).orderBy("t").collect()]
    assert got.index(True) == 9
    assert inbox.longest_streaks(df, "u", ["t"], F.col("bad")).first().longest == 8
    e = spark.createDataFrame([(1, 0), (1, 600), (1, 4000), (2, 0)], "u int, s int").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.n for r in inbox.sessions(e, "u", "ts").collect()) == [1, 1, 2]


def test_readers(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('video_id,title,n\na,"two\nlines ""quoted""",007\n', "utf-8-sig")
    assert readers.csv_header(spark, str(p)) == ["video_id", "title", "n"]
    r = readers.read_table(spark, str(p), ["n", "absent", "title"]).first()
    assert r.asDict() == {"n": "007", "title": 'two\nlines "quoted"'}
    assert readers.row_skew(spark, str(p), 1) == 1
    q = tmp_path / "y.parquet"
    spark.createDataFrame([("b",)], "video_id string").write.parquet(str(q))
    both = readers.read_many(spark, [str(p), str(tmp_path / "none.csv"), str(q)])
    assert sorted((x.video_id, x.source_name) for x in both.collect()) == [("a", "x"), ("b", "y")]
    with pytest.raises(FileNotFoundError):
        readers.read_many(spark, [str(tmp_path / "none.csv")], missing="raise")
    bad = spark.createDataFrame([(1, 2)], "foo int, bar int")
    assert readers.check_table(bad, ["video_id"]) == ["HARD: missing column video_id"]
    with pytest.raises(ValueError):
        readers.require_columns(bad, ["video_id"])
    readers.write_csv(both, str(tmp_path / "people.csv"), bom=True)
    assert (tmp_path / "people.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    readers.write_report(bad, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == [{"foo": 1, "bar": 2}]
    np.save(tmp_path / "v.npy", np.arange(6, dtype=np.float16).reshape(3, 2))
    assert [x.embedding for x in readers.import_npy(spark, str(tmp_path / "v.npy"), ["a", "b", "c"]).orderBy("row").collect()] == [[0, 1], [2, 3], [4, 5]]
    pics = tmp_path / "pics"
    pics.mkdir()
    for name, size in (("a_hqdefault", 2000), ("a_maxresdefault", 2000), ("b_maxresdefault", 10), ("b_0", 1600)):
        (pics / f"{name}.jpg").write_bytes(b"x" * size)
    assert {(x.video_id, os.path.basename(x.path)) for x in readers.read_pictures(spark, str(pics)).collect()} == {("a", "a_maxresdefault.jpg"), ("b", "b_0.jpg")}


def test_atomic_write_keeps_the_old_file(tmp_path):
    p = tmp_path / "f.txt"
    readers.atomic_text(str(p), "old")
    with pytest.raises(UnicodeEncodeError):
        readers.atomic_text(str(p), "\ud800")
    assert p.read_text() == "old"


def test_remote(spark):
    assert remote.error_kind("HTTP 429 Too Many Requests") == "transient" and remote.error_kind("Private video") == "permanent" and remote.error_kind("odd") == "unknown"
    now = [0.0]
    gate = remote.AdaptiveGate(4, 10, lambda: now[0])
    gate.throttled()
    assert gate.limit == 3
    gate.trip()
    now[0] = 25
    with gate:
        assert gate.limit == 3
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("429")
        return "ok"

    assert remote.with_retries(flaky, 3, waits.append) == "ok" and [int(w) for w in waits] == [2, 4]

    def client():
        def call(row):
            if row["id"] == 2:
                raise RuntimeError("timeout")
            return {"answer": f"a{row['id']}"}

        return call

    got = {r.id: (r.answer, r.error) for r in remote.call_per_row(spark.range(1, 4), client, "id long, answer string, error string").collect()}
    assert got[1] == ("a1", None) and got[2][1].startswith("transient") and got[3][0] == "a3"


def test_stages(spark, tmp_path):
    m = stages.Manifest.for_folder(str(tmp_path / "cat" / "src_b01"))
    assert (m.data["category"], m.data["source"], m.data["batch"]) == ("cat", "src", "b01")
    r = stages.Recipe(["quality", "qc", "clean"], on_request=["qc"])
    work = {s: lambda s=s: stages.StageResult(s, 10, 4) for s in r.stages}
    assert r.next_stage(m) == "quality"
    done = r.run(m, work, upto="clean")
    assert [x.name for x in done] == ["quality", "clean"] and done[0].retention == 40.0 and r.next_stage(m) is None
    assert stages.Manifest(m.path).data["stages"]["clean"]["rows_out"] == 4
    assert r.checklist(m) == [("quality", True), ("qc", False), ("clean", True)]
    with pytest.raises(ValueError):
        r.run(m, work, upto="zzz")
    assert stages.StageResult("x").retention == 0.0
    assert stages.write_progress(str(tmp_path / "p.json"), 5, 20, 2)["pct"] == 25.0
    assert stages.load_catalogue(str(tmp_path / "none.toml")) == {}
    (tmp_path / "c.toml").write_text('[[datasets]]\ncategory = "a"\nv = 1\n[[datasets]]\ncategory = "a"\nv = 2\n')
    assert stages.load_catalogue(str(tmp_path / "c.toml"))["a"].options["v"] == 2
    assert stages.sha256_of(spark, str(tmp_path / "c.toml")).first().length > 0
    reg = stages.Registry()
    reg.register("x")(len)
    assert reg.get("x") is len
    with pytest.raises(KeyError):
        reg.get("y")


def test_work_tables_can_be_cleaned(spark):
    from siftline.session import clean_work, materialise

    clean_work(spark)
    df = materialise(spark.range(3), "x")
    assert df.count() == 3 and clean_work(spark) == 1 and clean_work(spark) == 0
    assert not os.path.exists(df.inputFiles()[0].removeprefix("file://")) if df.inputFiles() else True


def test_entry_and_catalogue(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    names, sql = set(e.queries()), set(e.oracle_sql())
    assert sql <= names and len(names) > 60


def test_core_queries_equal_their_sql(spark, sf):
    import glob

    import duckdb

    from siftline.plans import catalogue

    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    queries = catalogue.queries()

    def plain(rows):
        return sorted(repr([round(x, 6) if isinstance(x, float) else str(x) for x in r]) for r in rows)

    for name, sql in catalogue.oracle_sql().items():
        df = queries[name](spark, sf)
        want = con.execute(sql)
        cols = [c[0] for c in want.description]
        assert sorted(cols) == sorted(df.columns), name
        assert plain(want.fetchall()) == plain(tuple(r) for r in df.select(*cols).collect()), name


def test_folds_of_the_svm_share_their_passes(spark, monkeypatch):
    """One job a step for all folds, not one a step and fold; and margins that separate, with a fold of empty titles scored by the intercept."""
    from siftline.operators import lockstep

    steps = []
    kept = lockstep.minimise

    def counted(*a):
        fit, n = kept(*a), 0
        try:
            x = next(fit)
            while True:
                n += 1
                x = fit.send((yield x))
        except StopIteration as end:
            steps.append(n)
            return end.value

    monkeypatch.setattr(lockstep, "minimise", counted)
    rows = [(f"k{i}", None if i % 20 == 0 else ("good calm talk " if i % 2 else "bad loud noise ") + f"w{i % 7}", i % 2) for i in range(90)]
    df = models.text_columns(spark.createDataFrame(rows, "id string, title string, y int"), "title")
    spark.sparkContext.setJobGroup("svm", "")
    got = {r.id: r for r in models.calibrated_svm(df, "id", "y", 3, iterations=30).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("svm"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 90 and len(steps) == 3 and jobs < max(steps) + 60
    full = [got[r[0]] for r in rows if r[1]]
    assert min(r.score for r in full if r.y) > max(r.score for r in full if not r.y)
    assert len({round(got[r[0]].score, 6) for r in rows if not r[1]}) <= 3


def test_folds_of_the_fusion_share_their_passes(spark):
    """Scores are those of `fusion_pipeline` with its medians, scales and vocabularies per fold; one job a step serves all folds."""
    rows = [(i, "" if i % 30 == 0 else ("good calm " if i * 7 % 10 < 5 else "bad loud ") + f"w{i % 5} v{i % 3}", int(i * 7 % 10 < 6), None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i % 13), i % 2) for i in range(120)]
    df = models.text_columns(spark.createDataFrame(rows, "id int, title string, y int, n double, f int"), "title").coalesce(1)
    spark.sparkContext.setJobGroup("fusion", "")
    got = {r.id: r.score for r in models.fusion_scores(df, "id", "y", ["n"], 2, "f", tolerance=1e-9).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fusion"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 150
    want = models.out_of_fold(df, "id", "y", lambda train: models.fusion_pipeline(["n"], models.logistic(train.agg(F.sum("weight")).first()[0], tolerance=1e-9)), 2, fold_col="f").collect()
    assert len(got) == len(want) == 120 and max(abs(got[r.id] - r.score) for r in want) < 2e-3
