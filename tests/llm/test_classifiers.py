import random
import zlib

import numpy as np
import pytest

from keystrata.llm import catalogue, language, toxicity

SMALL = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = catalogue.op2_toxicity(spark, SMALL).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = ([s for y, s in held if y == k] for k in (1, 0))
    # About forty toxic texts to learn from: the order must be good, whatever the threshold makes of it.
    assert np.mean([[a > b for b in clean] for a in toxic]) > 0.8
    assert np.mean([s >= 0.5 for s in clean]) < 0.05


def _texts(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        if i % 3 == 0:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(["zqxa", "zqxo", "vvkw"])
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return rows


def test_toxicity_edge_cases(spark):
    rows = _texts(1, 150)
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows] + [(None, None, "x", 1.0), (900, "", "x", 1.0), (900, "zqxa " * 20_000, None, None), (901, "日本語 １２", "x", 2.0), (902, "w" * 5000, "x", 2.0)], "doc_id long, text string, whole string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (900, None), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 155
    by_id = {r.doc_id: r for r in found if r.doc_id is not None and r.doc_id != 900}
    assert all(by_id[i].predicted == y for i, _, y in rows) and by_id[901].predicted == 0 and by_id[902].predicted == 0
    assert sorted(r.predicted for r in found if r.doc_id == 900) == [0, 1]
    assert [r.predicted for r in found if r.doc_id is None] == [0]
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for labels in (none, one):
        assert [r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] in ([0], [1])


def test_words_unknown_to_both_classes_cost_both_alike():
    k, gram, parent = np.array([0, 0]), toxicity._beginnings(*toxicity._spelled([b""]))[:1].repeat(2), np.zeros(2, np.uint64)
    gram = np.array([gram[0], 1], np.uint64)
    model = toxicity.ToxicityModel.of_counts(k, gram, parent, np.array([[900, 5], [30, 1]]))
    assert np.allclose(model.word_differences([b"zz", b"\xe6\x97"]), 0)


def test_language_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    rows = catalogue.op4_language_id(spark, SMALL).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_language_edge_cases(spark):
    rows = [(i, t * (1 + i % 40), lang) for i in range(120) for t, lang in [[("the house and garden ", "en"), ("das Haus über dem Weg ", "de")][i % 2]]]
    docs = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in rows] + [(None, None, None, "x", 1), (500, "", "en", "x", 1), (501, " 12 !? ", None, "x", 1), (502, "über dem Haus " * 9000, None, "x", 1), (502, "日", None, "x", 1)], "doc_id long, text string, lang string, score string, lang_pred int")
    net = language.fit(docs, steps=150)
    assert net.languages == ["de", "en"]
    found = language.identify(docs, net).collect()
    assert sum(r.lang_pred == lang for r in found for i, _, lang in rows if r.doc_id == i) >= 118
    assert {r.lang_pred for r in found if r.doc_id in (None, 500, 501)} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id == 502} <= {"de", "en"} and all(0 <= r.score <= 1 for r in found)
    assert language.identify(docs.limit(0), net).collect() == []
    nothing = language.fit(docs.filter("lang is null"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}


def test_gradients_and_tables_agree_with_the_network():
    net = language.ByteCNN(["a", "b", "c"])
    net.start(1)
    for name in net.parameters:
        net.parameters[name] = net.parameters[name].astype(np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (4, language.WINDOW)), np.array([0, 1, 2, 1])
    loss = lambda: -np.mean(net.log_probabilities(x, net.tables()).astype(np.float64)[np.arange(4), y])
    g = net.gradients(x, y)
    for name, at in (("out", (3, 1)), ("bias", (5,)), ("filter3", (4, 2)), ("embedding", (int(x[0, 9]), 3))):
        before = net.parameters[name][at]
        values = []
        for step in (1e-3, -1e-3):
            net.parameters[name][at] = before + step
            values.append(loss())
        net.parameters[name][at] = before
        assert (values[0] - values[1]) / 2e-3 == pytest.approx(g[name][at], abs=2e-3)


def test_toxicity_learns_from_the_whole_of_long_words():
    import pyarrow as pa

    text = "日本語文" * 20 + "毒毒毒"
    parts = toxicity._parts(text.encode())
    assert b"".join(parts) == text.encode() and all(len(p) <= 64 and p.decode() for p in parts)
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([1])], names=["text", "toxic"])
    counted = pa.Table.from_batches(toxicity._count(iter([batch])))
    ones = [n for k, n in zip(counted.column("k").to_pylist(), counted.column("n1").to_pylist()) if k == 1]
    assert sum(ones) == len(text.encode()) + 2 * len(parts)


def test_toxicity_of_a_text_inside_the_id(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["good day", "bad bad day", None, "", "bad"] * 8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("bad" in (t or ""))) for i, t in enumerate(["good day", "bad bad day", None, "", "bad"] * 8)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    plain = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    nested = toxicity.score(docs.selectExpr("struct(doc_id, text) as document"), model, id_column="document", text_column="document.text").collect()
    assert {r.document.doc_id: r.score for r in nested} == plain and len(plain) == 40
