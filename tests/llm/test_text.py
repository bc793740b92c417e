"""Sentence units and languages."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftline.llm import langid, sentences


@pytest.mark.parametrize(
    ("lang", "units"),
    [
        ("en", ["Dr. Lee paid approx. 6.1 dollars at Foo Inc. and left.", "It works!! 🔥", "Next one"]),
        ("en", ["We met Mr. J. K. Ode at 8 p.m. near the U.S. office.", "Version 3.25.27 fixed it, i.e. no. 18!"]),
        ("en", ['The label says "Keep dry! Keep cool!" in red.', '"Is this a joke?" she asked.']),
        ("en", ["Well... it did turn on...", "Then it died."]),
        ("de", ["Am 5. Mai kam es in der Bahnstr. 3 an, d. h. viel zu spät.", "„Ist das ein Witz?“, fragte sie...", "„Nein“, sagte er."]),
        ("fr", ["Voir p. 29, c.-à-d. la partie de M. Nuku.", "L'étiquette dit « Garder au sec ! Ne pas jeter ! » en rouge ?!", "Oui."]),
        ("es", ["La Sra. Vega pagó aprox. 71,1 euros en Toro S.A. con envío.", "¿Vale?", "Sí."]),
        ("it", ["Il dott. Rossi e la sig.ra Verdi dicono 4,2 kg.", "Bene."]),
        ("ru", ["См. стр. 12, т. е. раздел и т. д. до конца.", "Забрал на ул. Мира д. 6 за 82,7 руб. вчера."]),
        ("zh", ["第29.5版修好了。", "“这是开玩笑吗？”她问。", "嗯……亮了！"]),
        ("ja", ["「これは冗談ですか？」と言いました！！", "うーん……点きました。"]),
        ("ko", ['음... 켜졌습니다.', '"농담이야?" 하고 물었습니다.', "무게는 8.2 kg이고 큽니다?!"]),
        ("th", ["ของดีมาก", "ราคา 25 บาทจากร้าน Foo ในเมือง", "บนฉลากเขียนว่า “เก็บให้แห้ง!” ด้วยสีแดง"]),
        ("ar", ["قال د. سامي إن وزنه 84.8 كغ.", "هل هذا جيد؟", "نعم!"]),
    ],
)
def test_sentences_by_language(lang, units):
    for sep in (" ", "\n", "\n\n  "):
        text = sep.join(units)
        assert [text[a:b] for a, b in sentences.units(text, lang)] == units
        assert [text[a:b] for a, b in sentences.units(text, None)] == units


def test_sentences_without_blanks_and_in_lower_case():
    assert len(sentences.units("It was closed.The next one came!And more")) == 3
    t = "mein zweiter lief gut. la sra. vega vino. ok"
    assert [t[a:b] for a, b in sentences.units(t)] == ["mein zweiter lief gut.", "la sra. vega vino.", "ok"]
    assert sentences.units(None) == sentences.units("") == sentences.units(" \n ") == []
    assert sentences.units('"never closed. but still') == [(0, 14), (15, 24)]


def test_sentences_are_ordered_and_lose_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").toPandas()
    for text, lang in zip(docs["text"], docs["lang"], strict=True):
        spans = sentences.units(text, lang)
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert "".join("".join(text[a:b].split()) for a, b in spans) == "".join((text or "").split())


def test_long_addresses_are_not_cut():
    for head in ("https://site.test/", "www.site.test/", "someone@"):
        text = f"See {head}{'a' * 60}.alpha/{'b' * 60}.beta now. Next one."
        assert [text[a:b] for a, b in sentences.units(text, "en")] == [text[:-10], "Next one."]


def test_sentence_query_edges(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "One. Two.", "zz"), (3, "One. Two.", "zz"), (None, "x", "en"), (4, "word. " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("sent_start", F.lit("clash"))
    got = sentences.sentence_units(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {3: 4, 4: 30_000}
    assert sentences.sentence_units(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def labelled(spark, sf):
    c = spark.read.parquet(f"{sf}/../sf0.01/candidates.parquet")
    text = F.concat_ws("\n", *(langid.present(f) for f in ("title", "description")))
    rows = c.select("row_id", text.alias("text"), langid.label_code("lang").alias("label"), "title", "description").where("label is not null and text <> ''").orderBy(F.xxhash64("row_id")).limit(2600).toPandas()
    model = langid.train(rows["text"][:2200].tolist(), rows["label"][:2200].tolist(), per_class=1500)
    return model, rows[2200:]


def test_language_accuracy_on_held_out_rows(labelled):
    model, held = labelled
    batch = held[["row_id", "label", "title", "description"]].reset_index(drop=True)
    out = pd.concat(langid._detector(model, ["title", "description"])(iter([batch])))
    main = out.assign(size=out.stretch_end - out.stretch_start).sort_values("size").groupby("row_id").last()
    both = batch.set_index("row_id").join(main, how="inner", rsuffix="_got")
    assert (both["label"] == both["lang"]).mean() > 0.88  # about one label in twenty is wrong by design of the table
    assert out["confidence"].between(0, 1).all()


def test_language_cases(labelled, spark):
    model, _ = labelled
    de = "Am Abend polierte Komosa den Wollteppich anstelle von die Gartenhacke damit ihr es zu Hause probieren könnt."
    en = "Later that evening Zirode polished the bread oven behind the chapel because the first attempt failed."
    rows = [
        (1, de, de, "de"), (2, de, de, "en"), (3, en, f"{en}\n{de}", "en"), (4, en, None, None), (5, None, "nan", None), (6, "", "#tag @name https://x.example 00:00", "und"),
        (7, en, en, "xx"), (8, en, en, "English"), (None, en, en, None), (9, en, " ".join([en] * 300), "en-US"),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, title string, description string, lang string").withColumn("label", F.lit("clash")).withColumn("used", F.lit(0))
    found = langid.stretches(df, model)
    got = {tuple(r) for r in langid.label_cases(found).collect()}
    assert got == {(2, "title", "de"), (2, "description", "de"), (3, "title", "en"), (3, "description", "en"), (3, "description", "de"), (4, "title", "en"), (7, "title", "en"), (7, "description", "en")}
    parts = sorted((r.stretch_start, r.stretch_end, r.lang) for r in found.where("row_id = 3 and field_name = 'description'").collect())
    assert [p[2] for p in parts] == ["en", "de"] and parts[0][1] <= parts[1][0] + 1
    assert langid.stretches(df.limit(0), model).count() == 0


def test_languages_are_learned_without_tags(spark, sf):
    c = spark.read.parquet(f"{sf}/../sf0.01/candidates.parquet")
    rows = c.select(langid.label_code("lang").alias("label"), *(F.regexp_replace(langid.present(f), "[#@]", "").alias(f) for f in ("title", "description")), "row_id").where("label is not null and title is not null and description is not null").orderBy(F.xxhash64("row_id")).limit(1500).toPandas()
    text, held = rows["title"] + "\n" + rows["description"], rows[1200:].reset_index(drop=True)
    model = langid.train(text[:1200].tolist(), rows["label"][:1200].tolist(), per_class=800)
    out = pd.concat(langid._detector(model, ["title", "description"])(iter([held])))
    main = out.assign(size=out.stretch_end - out.stretch_start).sort_values("size").groupby("row_id").last()
    both = held.set_index("row_id").join(main, how="inner", rsuffix="_got")
    assert len(both) > 0.8 * len(held) and (both["label"] == both["lang"]).mean() > 0.8


def test_nothing_to_train_on_gives_no_stretches(spark):
    en = "Later that evening Zirode polished the bread oven behind the chapel because the first attempt failed."
    df = spark.createDataFrame([(1, en, en, None), (2, en, None, "xx")], "row_id bigint, title string, description string, lang string")
    unlabelled = langid.fit_on(df, F.col("lang"), ["title", "description"])
    for model in (unlabelled, langid.train([], []), langid.train(["one", "two"], ["en", "de"])):
        assert np.allclose(model.probabilities(langid.cut([en])), 1 / (langid.NONE + 1))
        assert langid.stretches(df, model).count() == 0


def test_weights_are_fitted_once(spark, sf, monkeypatch, tmp_path):
    monkeypatch.setattr(langid, "shared_dir", lambda spark: f"file://{tmp_path}")
    c = spark.read.parquet(f"{sf}/candidates.parquet")
    fitted = []
    fit = langid.train
    monkeypatch.setattr(langid, "train", lambda *a: fitted.append(1) or fit(*a))
    one, two = (langid.fit_on(c.repartition(n), F.col("lang"), ["title", "description"], sample=30) for n in (1, 3))
    assert len(fitted) == 1 and all(np.array_equal(a, b) for a, b in ((one.conv, two.conv), (one.bias, two.bias), (one.out, two.out), (one.base, two.base)))
    langid.fit_on(c.where("row_id > 5"), F.col("lang"), ["title", "description"], sample=20)
    assert len(fitted) == 2


def test_label_codes(spark):
    given = ["en-US", "pt_BR", "zh-Hans", "German", "deu", "ES", "und", "xx", "", None, "nan", " fr "]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in given], "lang string").select(langid.label_code("lang")).collect()]
    assert got == ["en", "pt", "zh", "de", "de", "es", None, None, None, None, None, "fr"]
