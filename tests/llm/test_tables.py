"""Caps, splits, cutoffs, leaks and mixing against plain Python, and their edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from siftline.llm import caps, cutoffs, leaks, mixing, splits


def test_caps_keep_the_best_whatever_the_batches(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", None, " @HOT "]), f"v{rng.randrange(120)}", rng.randrange(4)) for i in range(300)] + [(None, "hot", "v1", 0), (900, "nan", "v1", 0), (901, "hot", None, None)]
    scores = [(f"v{i}", rng.choice([0.1, 0.5, 0.5, 0.9, None, float("nan"), 1.5]), rng.randrange(5)) for i in range(120) for _ in range(rng.randrange(3))]
    c = spark.createDataFrame(rows, "row_id bigint, channel string, video_id string, batch_no int").withColumn("score", F.lit("clash")).withColumn("contributor", F.lit("clash"))
    s = spark.createDataFrame(scores, "video_id string, ml_score double, t int").withColumn("scored_at", F.timestamp_seconds("t"))
    best = {}
    for v, x, t in scores:
        if x is not None and 0 <= x <= 1:
            best[v] = max(best.get(v, (-1, -1)), (t, x))
    want = set()
    names = {}
    for i, ch, v, _ in rows:
        key = None if ch is None or ch.strip() in ("", "nan") else ch.strip().lstrip("@").lower()
        if key and i is not None:
            names.setdefault(key, []).append((-best[v][1] if v in best else 9, i))
    for members in names.values():
        want |= {i for _, i in sorted(members)[25:]}
    state = caps.capped_channels(c, s, 25)
    assert {r.row_id for r in state.log().collect()} == want
    assert {r.row_id for r in state.kept().collect()} == {i for m in names.values() for _, i in sorted(m)[:25]}
    assert caps.cap_for_share(1000, 0.05) == 50 and caps.cap_for_share(3, 0.1) == 1


def test_caps_of_nothing(spark):
    c = spark.createDataFrame([], "row_id bigint, channel string, video_id string, batch_no int")
    s = spark.createDataFrame([], "video_id string, ml_score double, scored_at timestamp")
    assert caps.capped_channels(c, s).log().count() == 0
    with pytest.raises(ValueError):
        caps.CapState(spark, 0)


def test_splits_keep_sets_together(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "", f"g{rng.randrange(40)}", f"https://x.example/@G{rng.randrange(40)}"]), rng.choice([None, f"c{rng.randrange(60)}"]), None, rng.choice([None, "nan", f"v{rng.randrange(150)}"]), rng.choice(["train", "train", "calibration", "holdout", "review", None]), "s") for i in range(260)]
    df = spark.createDataFrame(rows, "label_id bigint, label_group string, channel string, source_ref string, video_id string, split string, source string").withColumn("g", F.lit("clash")).withColumn("component", F.lit("clash"))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, g, c, _, v, _, _ in rows:
        name = (g or "").split("/@")[-1].lower() or c
        for key in ([("g", name)] if name else []) + ([("v", v)] if v not in (None, "nan") else []):
            parent[find(("row", i))] = find(key)
    groups = {}
    for r in rows:
        groups.setdefault(find(("row", r[0])), []).append(r)
    three = ("train", "calibration", "holdout")
    want = {r[0] for m in groups.values() if len({x[5] for x in m} & set(three)) > 1 for r in m if r[5] in three}
    sets = splits.related_sets(df).persist()
    assert {r.label_id for r in splits.violations(sets).collect()} == want
    new = splits.assign(sets, {"train": 0.6, "calibration": 0.2, "holdout": 0.2}).collect()
    assert len(new) == len(rows)
    place = {r.label_id: r.new_split for r in new}
    assert all(len({place[r[0]] for r in m}) == 1 for m in groups.values())
    largest = max(len(m) for m in groups.values())
    assert abs(sum(s == "holdout" for s in place.values()) - 0.2 * len(rows)) <= largest + 1
    with pytest.raises(ValueError):
        splits.assign(sets, {})
    assert splits.violations(splits.related_sets(df.limit(0))).count() == 0


def test_cutoffs_against_sorting(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", "a", "B ", "c"]), f"v{i}", rng.choice([0.1, 0.25, 0.5, 0.75, rng.random()])) for i in range(400)]
    values = spark.createDataFrame(rows, "source string, video string, score double").withColumn("source", F.lower(F.trim("source")))
    targets = spark.createDataFrame([(" A", 333), ("b", 1000), ("c", 0), ("none", 500), ("a", None)], "source string, keep_permille int").withColumn("score", F.lit(1))
    report, kept = cutoffs.cutoffs(values, targets, 6)
    got = {}
    for r in kept.collect():
        got.setdefault(r.source, set()).add(r.video)
    want = {}
    for s, p in (("a", 333), ("b", 1000)):
        own = sorted([(x, v) for t, v, x in rows if t.strip().lower() == s], reverse=True)
        k = -(-len(own) * p // 1000)
        want[s] = {v for x, v in own if x >= own[k - 1][0]}
    assert got == want
    rep = {r.source: r for r in report.collect()}
    assert rep["none"].n == 0 and rep["none"].cutoff is None and rep["c"].kept == 0 and rep["a"].kept == len(want["a"])
    assert cutoffs.cutoffs(values.limit(0), targets)[1].count() == 0


def test_cutoffs_read_valid_scores(spark):
    labels = spark.createDataFrame([("X ", " v1"), ("x", "v1"), ("x", "v2"), (None, "v3"), ("x", None)], "source string, video_id string")
    scored = spark.createDataFrame([("v1", 0.2, 1), ("v1", 0.4, 2), ("v1", 7.0, 3), ("v2", None, 1), ("v2", float("nan"), 2), ("v3", 0.1, 1)], "video_id string, ml_score double, t int").withColumn("scored_at", F.timestamp_seconds("t"))
    assert [tuple(r) for r in cutoffs.scored_sources(labels, scored).collect()] == [("x", "v1", 0.4)]


def test_leaks_against_windows(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30))) for i in range(12)] + [(50, "".join(rng.choice("日月火水木金土山川田") for _ in range(60))), (51, "too short"), (52, None), (53, items_copy := None)]
    items[3] = (3, items[1][1])  # a repeated passage
    docs = []
    for d in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        if d % 3 == 0:
            p = rng.choice(items[:12])[1].split()
            n = rng.randint(9, 18)
            at = rng.randrange(len(p) - n)
            words[5:5] = p[at : at + n]
        docs.append((d, (" , ".join(words)).upper() if d % 2 else "  ".join(words) + "."))
    cjk = items[12][1]
    docs += [(200, "前" + "、".join(cjk[10:34]) + "後"), (201, cjk[10:33]), (202, None), (203, ""), (204, items[0][1] + " x" * 20_000), (205, "a" * 300_000)]
    ddf = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    idf = spark.createDataFrame(items, "item_id bigint, passage string").withColumn("doc_id", F.lit("clash"))
    got = {(r.item_id, r.doc_id) for r in leaks.leaks(ddf, idf).collect()}
    want = set()
    import regex

    for i, p in items:
        for d, t in docs:
            if p is None or not t:
                continue
            if i == 50:
                a, b = "".join(regex.findall(r"[\p{L}\p{N}]", p)), "".join(regex.findall(r"[\p{L}\p{N}]", t.lower()))
                hit = any(a[k : k + 24] in b for k in range(len(a) - 23))
            else:
                a, b = p.split(), " " + " ".join(regex.findall(r"\w+", t.lower())) + " "
                hit = any(" " + " ".join(a[k : k + 13]) + " " in b for k in range(len(a) - 12))
            if hit:
                want.add((i, d))
    assert got == want and (50, 200) in got and (50, 201) not in got
    assert leaks.leaks(ddf.limit(0), idf).count() == 0 and leaks.leaks(ddf, idf.limit(0)).count() == 0
    assert items_copy is None
    # Spans: a word lies in one if and only if some window of 13 words around it stands in the item.
    text = dict(docs)
    got = {}
    for r in leaks.leak_spans(ddf, idf).collect():
        got.setdefault((r.item_id, r.doc_id), set()).update(range(r.span_start, r.span_end))
    for i, d in want - {(50, 200)}:
        p = dict(items)[i].split()
        grams = {tuple(p[k : k + 13]) for k in range(len(p) - 12)}
        ws = [(m.group().lower(), *m.span()) for m in regex.finditer(r"\w+", text[d])]
        inside = set()
        for k in range(len(ws) - 12):
            if tuple(w for w, _, _ in ws[k : k + 13]) in grams:
                inside.update(range(ws[k][1], ws[k + 12][2]))
        assert got[i, d] == inside
    assert set(got) == want


def test_leaks_are_removed(spark):
    p = [f"p{i}" for i in range(40)]
    q = [f"q{i}" for i in range(18)]
    items = spark.createDataFrame([(1, " ".join(p)), (2, " ".join(q)), (3, None)], "item_id bigint, passage string")
    long, short, much = " ".join(p[3:17]), " ".join(p[3:12]), " ".join(q[2:12])
    docs = [(1, f"Before {long.upper()}, after."), (2, f"Before {short}, after."), (3, f"Before {much}, after."), (4, None), (5, ""), (6, "İİ " + long + " end"), (None, "x"), (7, f"{long}. {long}"), (8, f"a {long} b {much} c")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("cuts", F.lit("clash")).withColumn("tokens", F.lit(0))
    got = {r.doc_id: (r.text, r.removed) for r in leaks.clean(df, items).collect()}
    assert got[1] == ("Before , after.", len(long)) and got[2] == (docs[1][1], 0)  # nine words of forty stay
    assert got[3] == ("Before , after.", len(much))  # ten words of eighteen do not
    assert got[4] == (None, 0) and got[5] == ("", 0) and got[None] == ("x", 0)
    assert got[6] == ("İİ  end", len(long)) and got[7] == (". ", 2 * len(long)) and got[8][0] == "a  b  c"
    assert leaks.clean(df, items.limit(0)).where("removed > 0").count() == 0
    assert leaks.clean(df.limit(0), items).count() == 0


def test_leaks_in_many_blocks_and_long_runs(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_TOKENS", 40)
    monkeypatch.setattr(leaks, "PASS_BLOCKS", 2)
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(20))) for i in range(9)]
    body = " ".join(rng.choice(vocab) for _ in range(1500))
    docs = [(1, body + " " + items[4][1] + " " + body), (2, body), (3, " ".join(p for _, p in items))]
    got = {(r.item_id, r.doc_id) for r in leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, passage string")).collect()}
    want = set()
    for i, p in items:
        w = p.split()
        for d, t in docs:
            if any(f" {' '.join(w[k : k + 13])} " in f" {t} " for k in range(8)):
                want.add((i, d))
    assert got == want and (4, 1) in got


def test_mixing_meets_targets_and_caps(spark):
    rng = random.Random(7)
    docs, i = [], 0
    for source, n in (("big", 300), (" Mid", 90), ("tiny", 8), (None, 5), ("other", 20)):
        for _ in range(n):
            docs.append((i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(3, 60))) + f" {i}", source))
            i += 1
    docs += [(i + k, docs[0][1], "big") for k in range(100)] + [(900, None, "big"), (901, "", "tiny"), (None, "x", "big")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("tokens", F.lit("clash")).withColumn("u", F.lit(0))
    t = spark.createDataFrame([("big", 50, 1), ("mid", 30, 2), ("TINY", 10, 4), ("absent", 10, 3), (None, 5, 1)], "source string, target_pct int, max_repeats int")
    chosen, report = mixing.mix(d, t)
    rep = {r.source: r for r in report.collect()}
    caps_ = {"big": 1, "mid": 2, "tiny": 4}
    assert set(rep) == {"big", "mid", "tiny", "absent"} and rep["absent"].tokens == 0
    assert all(r.copies <= caps_[r.source] for r in chosen.collect())
    assert chosen.where("doc_id > 423 and doc_id < 524").count() == 0  # copies of a text count once
    for s in caps_:
        assert abs(rep[s].tokens - rep[s].quota) <= 80
        assert abs(rep[s].share - rep[s].target_share) < 0.05
    again = mixing.mix(d.repartition(7), t)[0]
    assert {(r.doc_id, r.copies) for r in again.collect()} == {(r.doc_id, r.copies) for r in chosen.collect()}
    empty = mixing.mix(d.limit(0), t)
    assert empty[0].count() == 0 and {r.tokens for r in empty[1].collect()} == {0}


def test_scales_expect_the_tokens_that_are_due(spark):
    rng = random.Random(5)
    tokens = [rng.randint(1, 40) for _ in range(300)] + [400, 500, 900]
    sizes = spark.createDataFrame([(i, "a", t) for i, t in enumerate(tokens)] + [(900, "b", 5)], "doc_id int, source string, tokens bigint")
    for power in (0.0, 1.0, 2.0):
        for due in (0.0, 500.0, 3000.0, sum(tokens) - 1.0, sum(tokens) + 1.0):
            got = {r.source: r.scale for r in mixing._scales(sizes, spark.createDataFrame([("a", due), ("b", 0.0), ("none", 1.0)], "source string, due double"), power).collect()}
            expected = sum(t * min(1.0, got["a"] * t**power) for t in tokens)
            assert abs(expected - min(due, sum(tokens))) < 1e-6 * sum(tokens) and got["b"] == 0.0 and got["none"] == 1e300


def test_tokenizer_files_count_alike():
    texts = ["Hello  world", "", "こんにちは 12,5 kg", "it's <|endoftext|>\n\n x", "a" * 3000, " " * 3000, "x" + " " * 2000 + "y", "x" + "\n" * 2000 + "y z ", "\n" * 1500 + "end"]
    want = mixing._encoder("/opt/tokenizers/byte_bpe_50k.json")(texts)
    assert mixing._encoder(mixing.TOKENIZER)(texts) == want and want[1] == 0
    assert mixing._encoder(mixing.TOKENIZER)([" " * 1_000_000 + "x"])[0] > 1


def test_caps_go_on_in_another_process(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(caps, "COMPACT", 2)
    rng = random.Random(9)
    rows = [(rng.choice("abc"), i, rng.choice([None, -0.5, 0.1, 0.5, 0.5, 0.9])) for i in range(90)]
    path, schema = str(tmp_path / "state"), "contributor string, row_id bigint, score double"
    for b in range(5):
        caps.CapState(spark, 4, path=path).ingest(spark.createDataFrame(rows[b * 18 : b * 18 + 18], schema), b)
    caps.CapState(spark, 4, path=path).ingest(spark.createDataFrame([], schema), 5)
    state = caps.CapState(spark, 4, path=path)
    # A version that was left half-way does not count.
    spark.createDataFrame([("a", 999, 1.0, 9, "kept")], schema + ", batch int, reason string").write.partitionBy("reason").parquet(f"{path}/rows/v=7")
    state = caps.CapState(spark, 4, path=path)
    assert state.version == 6
    want = {i for c in "abc" for _, i in sorted((9 if s is None else -s, i) for x, i, s in rows if x == c)[:4]}
    assert {r.row_id for r in state.kept().collect()} == want
    log = state.log().collect()
    assert sorted(r.row_id for r in log) == sorted({i for _, i, _ in rows} - want) and {r.reason for r in log} == {"displaced", "below cutoff"}
    state.ingest(spark.createDataFrame([("b", 500, 2.0), ("b", 500, 2.0)], schema), 6)
    assert 500 in {r.row_id for r in caps.CapState(spark, 4, path=path).kept().collect()}
    with pytest.raises(ValueError, match="cap"):
        caps.CapState(spark, 5, path=path)
