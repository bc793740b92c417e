"""Near duplicates, components, history cells and cross-split overlaps against brute force, and their edge cases."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftline.llm import golay, neardup, overlap, units
from siftline.llm.cells import CellIndex, check_batches
from siftline.llm.components import connected_components

WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "lu", "mi", "ne", "ra") for b in ("do", "fi", "ga", "pe") for c in ("n", "r", "s", "t", "")]


def sets(texts):
    h, o = units.unit_sets(texts)
    return [frozenset(h[o[i] : o[i + 1]].tolist()) for i in range(len(texts))]


def alike(a, b, t=0.6):
    return bool(a and b) and len(a & b) >= t * len(a | b) - 1e-9


def groups_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def edited(rng, base):
    words = base.split()
    for _ in range(rng.randint(1, max(1, len(words) // 6))):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[i] = rng.choice(WORDS) + "x"
        elif kind < 0.7:
            words.insert(i, rng.choice(WORDS) + "y")
        else:
            words.insert(rng.randrange(len(words)), words.pop(i))
    return " ".join(words)


def test_units_follow_the_definition():
    got = sets(["Straße 12a, STRASSE", "日本語x", "ภาษาไทยดี", "ไทย", None, "", "!!!", "été"])
    assert len(got[0]) == 3  # straße, 12a, strasse
    assert len(got[1]) == 3  # two pairs and x
    assert len(got[2]) == 6 and len(got[3]) == 1  # runs of four; a shorter run whole
    assert got[4] == got[5] == got[6] == frozenset()
    assert len(got[7]) == 1
    assert sets(["a b a", "B A"])[0] == sets(["a b a", "B A"])[1]
    assert units.number_keys(["x 12 7", "7 and 12", "12", "none", None]).tolist()[0] == units.number_keys(["7 12"]).tolist()[0]
    assert units.number_keys(["none", None]).tolist() == [0, 0]


def test_golay_words_within_two_bits_share_a_key():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 3000)
    for d in (0, 1, 2):
        e = np.array([sum(1 << int(b) for b in rng.choice(23, d, replace=False)) for _ in v], dtype=np.int64)
        a, b = golay.keys(v), golay.keys(v ^ e)
        assert ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2)).all()
    assert (golay.keys(v) >= 0).sum(1).max() == 6


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 901 + i) for i in range(80)] + [(5, 5), (None, 3), (7, 9), (9, 7)]
    got = {r.vertex: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = groups_of(real, {x for e in real for x in e})
    assert set(got) == set(want)
    assert len({(got[v], want[v]) for v in want}) == len(set(want.values())) == len(set(got.values()))


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    rows, i = [], 0
    for _ in range(60):
        base = " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(rng.randint(12, 60)))
        for k in range(rng.choice((1, 1, 2, 4))):
            text = base if k == 0 else edited(rng, base)
            cut = len(text) // 3
            rows.append((i, text[:cut], text[cut:], "clash"))
            i += 1
    rows += [(1000, None, None, "x"), (1001, "", " nan ", "x"), (1002, "!!!", None, "x"), (1003, "same words here", None, "x"), (1004, None, "Same, words HERE", "x"), (1005, "same words here", "", "x"), (None, "same words here", "", "x"), (1006, "long " * 50_000 + "tail", None, "x"), (1007, "Long tail", None, "x")]
    df = spark.createDataFrame(rows, "row_id bigint, title string, description string, component string").withColumn("text", F.lit("clash")).withColumn("a", F.lit(1))
    got = {tuple(sorted((r.row_id_a, r.row_id_b))) for r in neardup.group_pairs(neardup.near_duplicate_groups(df, "row_id", neardup.joined_text("title", "description"))).collect()}
    live = [(r[0], " ".join("" if x is None or x.strip() in ("", "nan") else x for x in r[1:3])) for r in rows if r[0] is not None]
    s = sets([t for _, t in live])
    pairs = [(live[x][0], live[y][0]) for x in range(len(live)) for y in range(x) if alike(s[x], s[y])]
    want_groups = groups_of(pairs, [n for n, _ in live])
    ids = [n for n, _ in live]
    want = {tuple(sorted((a, b))) for a in ids for b in ids if a != b and want_groups[a] == want_groups[b]}
    assert (1003, 1004) in want and (1006, 1007) in want
    assert got == want


def dense(n):
    """A group whose texts all differ a little, and some others."""
    rng = random.Random(12)
    base = [rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(60)]
    rows = [" ".join(base[:k % 3] + [f"one{k}"] + base[k % 3 + 1 :]) for k in range(n)]
    return rows + [" ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(50)) for _ in range(n)]


def test_a_dense_group_costs_a_link_a_row(spark):
    texts = dense(400)
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    reps = spark.createDataFrame(pd.concat(neardup._sketch(iter([pd.DataFrame({"id": range(len(texts)), "text": texts})]))))
    assert neardup.candidate_pairs(reps, 0.6).count() < 400 * 400 / 8
    got = neardup.near_duplicate_groups(df, "row_id", F.col("text")).collect()
    assert sorted(r.id for r in got) == list(range(400)) and len({r.component for r in got}) == 1


@pytest.mark.parametrize("change", [{"ROWS_PER_TASK": 40}, {"NEAR": -3, "SMALL": 64}, {"MAX_BROADCAST_IDS": 0, "NEAR": -3}])
def test_tasks_by_codewords_and_refused_leaders(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(13)
    texts = dense(150)
    for _ in range(150):  # chains that end well under the threshold
        words = texts[rng.randrange(len(texts))].split()
        for _ in range(rng.randint(5, 15)):
            words[rng.randrange(len(words))] = f"{rng.choice(WORDS)}{rng.randrange(10**6)}z"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    got = {r.id: r.component for r in neardup.near_duplicate_groups(df, "row_id", F.col("text")).collect()}
    s = sets(texts)
    want = groups_of([(x, y) for x in range(len(s)) for y in range(x) if alike(s[x], s[y])], range(len(s)))
    assert {(i, j) for i in got for j in got if got[i] == got[j] and i < j} == {(i, j) for i in want for j in want if want[i] == want[j] and i < j}


def test_unrelated_texts_seldom_meet():
    """Of all pairs of texts over one vocabulary, those that meet are few, and fewer than those that share a codeword."""
    for n in (1000, 4000):
        rng = random.Random(14)
        texts = [" ".join([*(f"c{rng.randrange(60)}" for _ in range(10)), *(f"w{rng.randrange(20000)}" for _ in range(40))]) for _ in range(n)]
        sketch = next(neardup._sketch(iter([pd.DataFrame({"id": range(n), "text": texts})])))
        routed = pd.concat(neardup._route(1, {})(iter([sketch])))
        met = shared = 0
        for _, part in routed.groupby("pid"):
            key = part["key"].to_numpy()
            codes = golay.keys((key & (1 << golay.BITS) - 1).astype(np.int32))
            both = (key[:, None] >> golay.BITS << golay.INFO | codes)[codes >= 0]
            met += int(sum(c * (c - 1) // 2 for c in np.unique(both, return_counts=True)[1]))
            shared += int(sum(c * (c - 1) // 2 for c in np.unique(codes[codes >= 0], return_counts=True)[1]))
        assert met < 0.01 * n * n / 2 and met < 0.05 * shared


@pytest.mark.parametrize(("shared", "own"), [(48, 16), (62, 19), (52, 14)])  # similarity 0.60, 0.62 and 0.65
def test_recall_at_the_threshold(spark, shared, own):
    assert linked_at_the_threshold(spark, 1000, shared, own) >= 0.99


def test_large_buckets_are_divided_without_loss(spark, monkeypatch):
    """Even where every value is divided, two trials find the pairs at the threshold."""
    monkeypatch.setattr(neardup, "WIDE_ROWS", 0)
    monkeypatch.setattr(neardup, "BUCKET", 0)
    assert linked_at_the_threshold(spark, 1000, 48, 16) >= 0.99


@pytest.mark.parametrize("change", [{}, {"ROWS_PER_TASK": 40, "BUCKET": 30}])
def test_groups_of_a_wide_table_against_brute_force(spark, monkeypatch, change):
    for name, value in {"WIDE_ROWS": 0, **change}.items():
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(15)
    texts = dense(120)
    for _ in range(100):
        words = texts[rng.randrange(len(texts))].split()
        for _ in range(rng.randint(3, 8)):
            words[rng.randrange(len(words))] = f"{rng.choice(WORDS)}{rng.randrange(10**6)}z"
        texts.append(" ".join(words))
    got = {r.id: r.component for r in neardup.near_duplicate_groups(spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string"), "row_id", F.col("text")).collect()}
    s = sets(texts)
    want = groups_of([(x, y) for x in range(len(s)) for y in range(x) if alike(s[x], s[y])], range(len(s)))
    assert {(i, j) for i in got for j in got if got[i] == got[j] and i < j} == {(i, j) for i in want for j in want if want[i] == want[j] and i < j}


def test_rows_of_a_wide_table_meet_less_and_travel_once_a_word():
    """Of texts over one vocabulary, far fewer meet in a trial once large buckets are divided; a value that fills a task multiplies no row."""
    n, rng = 3000, random.Random(16)
    texts = [" ".join([*(f"c{rng.randrange(60)}" for _ in range(30)), *(f"w{rng.randrange(10**6)}" for _ in range(20))]) for _ in range(n)]
    sketch = next(neardup._sketch(iter([pd.DataFrame({"id": range(n), "text": texts})]), True))
    hot = int(pd.Series(golay.value(neardup._values(sketch, 0), 3)).mode()[0])
    met = {}
    for bucket in (0, n):
        routed = pd.concat(neardup._route(1, {(3, hot): (golay.WORDS, 4)}, True)(iter([sketch])))
        assert len(routed) == golay.WORDS * n and routed["pid"].max() >= golay.WORDS
        met[bucket] = 0
        for _, part in routed.groupby("pid"):
            key = part["key"].to_numpy()
            codes = golay.keys((key & (1 << golay.BITS) - 1).astype(np.int32))
            both = (neardup._divided(key >> golay.BITS, bucket)[:, None] << golay.INFO | codes)[codes >= 0]
            met[bucket] += int(sum(c * (c - 1) // 2 for c in np.unique(both, return_counts=True)[1]))
    assert met[0] * 3 < met[n]


def test_pairs_of_a_large_group_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PAIR_ROWS", 7)
    g = spark.createDataFrame([(i, 1 if i < 40 else 2) for i in range(45)], "id bigint, component bigint")
    got = [(r.row_id_a, r.row_id_b) for r in neardup.group_pairs(g).collect()]
    assert len(got) == len(set(got)) == 40 * 39 // 2 + 5 * 4 // 2 and all(a < b and (a < 40) == (b < 40) for a, b in got)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "row_id bigint, title string, description string")
    assert neardup.near_duplicate_groups(df, "row_id", neardup.joined_text("title", "description")).count() == 0


def linked_at_the_threshold(spark, n=1000, common=40, own=13):
    """Share of n pairs of similarity common / (common + 2 own) that are found."""
    rows = []
    for i in range(n):
        shared = " ".join(f"s{i}w{k}" for k in range(common))
        rows += [(2 * i + side, shared, " ".join(f"{'ab'[side]}{i}w{k}" for k in range(own))) for side in (0, 1)]
    df = spark.createDataFrame(rows, "row_id bigint, title string, description string")
    got = neardup.group_pairs(neardup.near_duplicate_groups(df, "row_id", neardup.joined_text("title", "description"))).collect()
    assert all(r.row_id_a + 1 == r.row_id_b and r.row_id_a % 2 == 0 for r in got)
    return len(got) / n


def test_hamming_filter_keeps_links_at_the_threshold(spark):
    assert linked_at_the_threshold(spark) >= 0.95


def test_golay_keys_meet_links_at_the_threshold(spark):
    assert linked_at_the_threshold(spark) >= 0.99


def test_golay_segments_are_apart():
    bits = [np.zeros((1, golay.LANES), np.uint64) for _ in range(golay.LANES * 64)]
    for i, lanes in enumerate(bits):
        lanes[0, i // 64] = np.uint64(1) << np.uint64(i % 64)
    for i, lanes in enumerate(bits):
        assert [j for j in range(golay.WORDS) if golay.word(lanes, j)[0]] == [j for j in (i // 23,) if j < golay.WORDS]


def titles(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.35:
            t = edited(rng, rng.choice(rows)[2] or "some words to start with")
        else:
            t = " ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 14))) + rng.choice(("", " 7", " 8 of 9"))
        rows.append((i, rng.choice((f"v{rng.randrange(n)}", f" https://x.example/watch?v=v{rng.randrange(n)} ", None, "nan")), rng.choice((t, t, t, t.upper(), None)), i * 4 // n))
    return rows


def bare(v):
    return None if v is None or v.strip().lower() in ("", "nan") else v.strip().split("watch?v=")[-1]


def numbers(t):
    import re

    return frozenset(re.findall(r"\d+", t or ""))


def same(x, y):
    return (bare(x[1]) is not None and bare(x[1]) == bare(y[1])) or (alike(*sets([x[2], y[2]])) and numbers(x[2]) == numbers(y[2]))


def test_history_in_bulk_and_batch_by_batch(spark):
    rows = titles(5, 160)
    schema = "row_id bigint, video_id string, title string, batch_no int"
    df = spark.createDataFrame([*rows, (None, "v1", "x", 0), (990, "v1", None, None)], schema).withColumn("cell", F.lit(3)).withColumn("units", F.lit("clash")).withColumn("first_row_id", F.lit(1))
    want = set()
    for y in rows:
        earlier = [x[0] for x in rows if x[3] < y[3] and same(x, y)]
        if earlier:
            want.add((min(earlier), y[0]))
    index = CellIndex(spark)
    v = index.vectors(df)
    index.append(v)
    assert {(r.first_row_id, r.row_id) for r in index.probe(v).collect()} == want
    assert {(r.first_row_id, r.row_id) for r in check_batches(df, CellIndex(spark, buckets=4)).collect()} == want
    # One row at a time, so that only the buckets of its cells are read.
    few = [r for r in rows if r[3] == 3][:6]
    one = index.probe(index.vectors(spark.createDataFrame(few, schema)))
    assert {(r.first_row_id, r.row_id) for r in one.collect()} == {p for p in want if p[1] in {r[0] for r in few}}


def test_history_is_not_moved_and_failed_batches_do_not_count(spark):
    rows = titles(11, 60)
    df = spark.createDataFrame(rows, "row_id bigint, video_id string, title string, batch_no int")
    index = CellIndex(spark, buckets=4)
    want = {(r.first_row_id, r.row_id) for r in check_batches(df.where("batch_no < 2"), index).collect()}
    v = index.vectors(df.where("batch_no = 2"))
    index._file(index.vectors(df.where("batch_no = 1").withColumn("row_id", -F.col("row_id") - 1)))  # filed, but never completed
    assert all(r.first_row_id >= 0 for r in index.probe(v).collect())
    step = index._file(v)
    cells, videos = spark.table(index._cells()), spark.table(index._videos())
    met = index._met(v.withColumn("row_id", F.explode(F.sequence(F.lit(1), F.lit(99)))), cells.where(F.col("step") == step), cells.where(F.col("step") < step), videos.where(F.col("step") == step), videos.where(F.col("step") < step))
    plan = met._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(plan) if "siftline_cells" in line]
    join = next(i for i, line in enumerate(plan) if "ShuffledHashJoin" in line)
    assert len(at) == 2 and not any("Exchange" in line for line in plan[join : at[1]]) and all("Bucketed: true" in plan[i] for i in at)
    again = {(r.first_row_id, r.row_id) for r in index.check(v).collect()}
    assert {(r.first_row_id, r.row_id) for r in index.found().collect()} == want | again


def test_history_is_taken_up_by_another_index(spark, tmp_path):
    rng = random.Random(6)
    low, high = WORDS[:8], WORDS[8:16]  # common in the first batch, and in the second
    mixed = [" ".join(rng.sample(low, 3) + rng.sample(high, 3)) for _ in range(40)]
    old = [(i, None, t, 0) for i, t in enumerate(mixed + [" ".join(rng.sample(low, 5)) for _ in range(60)])]
    new = [(100 + i, None, t, 1) for i, t in enumerate(mixed + [" ".join(rng.sample(high, 5)) for _ in range(60)])]
    schema = "row_id bigint, video_id string, title string, batch_no int"
    want = set()
    for y in new:
        earlier = [x[0] for x in old if same(x, y)]
        if earlier:
            want.add((min(earlier), y[0]))
    first = CellIndex(spark, str(tmp_path / "index"))
    first.append(first.vectors(spark.createDataFrame(old, schema)))
    second = CellIndex(spark, str(tmp_path / "index"))
    got = {(r.first_row_id, r.row_id) for r in second.probe(second.vectors(spark.createDataFrame(new, schema))).collect()}
    assert len(want) >= 40 and got == want
    with pytest.raises(ValueError, match="threshold"):
        CellIndex(spark, str(tmp_path / "index"), threshold=0.5)


def test_history_of_nothing(spark):
    index = CellIndex(spark)
    v = index.vectors(spark.createDataFrame([], "row_id bigint, video_id string, title string, batch_no int"))
    index.append(v)
    assert index.probe(v).count() == 0


def test_overlaps_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(r[0], r[1], r[2], rng.choice(("train", "train", "holdout", "calibration", "review", None)), rng.choice(("human", " Human", None))) for r in titles(9, 150)]
    rows += [(500, None, None, "train", "x"), (501, None, "", "holdout", "x"), (502, "nan", "...", "holdout", "x")]
    df = spark.createDataFrame(rows, "label_id bigint, video_id string, title string, split string, source string").withColumn("id", F.lit(1)).withColumn("unit", F.lit("clash")).withColumn("n", F.lit(0))
    got = {(r.label_id_a, r.label_id_b) for r in overlap.overlap_pairs(df).collect()}
    want = set()
    for x in rows:
        for y in rows:
            if x[3] == "train" and y[3] in ("holdout", "calibration") and same(x, y):
                want.add((min(x[0], y[0]), max(x[0], y[0])))
    assert got == want
    report = overlap.overlap_report(df).collect()
    assert sum(r.pairs for r in report) == len(want)
    assert overlap.overlap_pairs(df.limit(0)).count() == 0
