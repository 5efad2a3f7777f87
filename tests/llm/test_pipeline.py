import random
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from tests.llm import test_ngram_join, test_suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    common = ["".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rude = ["zzyxx", "qwkky", "xxvv", "kkqq"]
    texts, toxic = [], []
    for i in range(220):
        words = prose(rng.randrange(30, 120)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(max(3, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(rude)
        texts.append(" ".join(words))
        toxic.append(int(bad))
    clean = [t for t, bad in zip(texts, toxic) if not bad]
    passage = prose(70)
    more = clean[:10] + [clean[11] + " end", clean[12] + " and end"] + [prose(20) + " " + passage + " é" + prose(15) for _ in range(6)] + ["", None, "日本 " * 3]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts + more)]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, bad) for i, bad in enumerate(toxic) if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, toxic


def test_stages_against_brute_force(spark, folder, tmp_path):
    path, rows, toxic = folder
    kept = {0: spark.read.parquet(f"{path}/documents.parquet")}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        out = stage(spark, kept[n - 1], path)
        if n < len(corpus_pipeline.STAGES):
            assert out.columns == kept[0].columns
        out.write.parquet(f"{tmp_path}/{n}")
        kept[n] = spark.read.parquet(f"{tmp_path}/{n}")
    got = {n: sorted((r.doc_id, r.text) for r in kept[n].collect()) for n in range(1, 5)}

    ids = {i for i, _ in got[1]}
    wrong = sum((i in ids) == bool(bad) for i, bad in enumerate(toxic))
    assert wrong <= 4 and all(i in ids for i in range(len(toxic), len(rows)))

    first = {}
    for i, t in got[1]:
        first.setdefault(t or "", i)
    assert [i for i, _ in got[2]] == sorted(first.values())

    groups = test_ngram_join.brute([(i, t) for i, t in got[2]], 5, (80, 100))
    assert [i for i, _ in got[3]] == sorted(i for i, _, c in groups if i == c)
    assert len(got[3]) < len(got[2]) < len(got[1])

    spans = {i: s for i, _, s, _ in test_suffix_dedup.brute([(i, t) for i, t in got[3]], 200)}
    before = dict(got[3])
    assert [i for i, _ in got[4]] == [i for i, _ in got[3]]
    for i, t in got[4]:
        raw = (before[i] or "").encode()
        keep = np.ones(len(raw), bool)
        at = 0
        for c in before[i] or "":
            size = len(c.encode())
            keep[at : at + size] = not any(a <= at and at + size <= b for a, b in spans[i])
            at += size
        assert t == bytes(b for b, k in zip(raw, keep) if k).decode()
    assert sum(bool(s) for s in spans.values()) >= 5

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in kept[5].collect():
        documents[r.doc_id].append((r.piece, bytes(r.tokens)))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t in got[4]:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        assert b"".join(p[1] for p in sorted(documents[i])) == np.array(ids, "<u4").tobytes()
    assert all(sum(n for _, n in v) <= 1024 for v in sequences.values())


def test_registered_and_run(spark, folder):
    assert "pipeline" in entry_module.queries()
    assert [f"op{n}_" for n in range(1, 11)] == [next(q for q in entry_module.queries() if q.startswith(f"op{n}_")).split("_")[0] + "_" for n in range(1, 11)]
    assert corpus_pipeline.run(spark, folder[0]).count() > 100


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_and_null_ids_leave_one_copy(spark):
    rng = random.Random(7)
    prose = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    rows = [(1, prose[0]), (1, prose[0]), (None, prose[0])]  # a row repeated whole, and a copy without an id
    rows += [(None, prose[1]), (None, prose[1]), (None, prose[1] + " end")]  # no id at all
    rows += [(5, prose[2]), (None, prose[2] + " end"), (5, prose[2] + " the end")]  # near copies, an id shared
    rows += [(7, prose[3]), (7, prose[4]), (3, prose[4])]  # an id shared by different texts
    rows += [(9, None), (None, ""), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    exact = corpus_pipeline.drop_copies(spark, docs, "")
    found = sorted(((r.doc_id, r.text or "") for r in exact.collect()), key=str)
    once = [(1, prose[0]), (None, prose[1]), (None, prose[1] + " end"), (5, prose[2]), (None, prose[2] + " end"), (5, prose[2] + " the end"), (7, prose[3]), (3, prose[4]), (8, "")]
    assert found == sorted(once, key=str)
    for given in (docs, exact):
        near = corpus_pipeline.drop_near_copies(spark, given, "")
        assert near.columns == docs.columns
        kept = [(r.doc_id, r.text) for r in near.collect() if r.text]
        assert sorted(i for i, _ in kept if i is not None) == [1, 3, 5, 7]
        assert sum(i is None for i, _ in kept) == 1 and {t[:200] for _, t in kept} == {t[:200] for t in prose[:5]}
    cut = corpus_pipeline.cut_repeats(spark, corpus_pipeline.drop_near_copies(spark, exact, ""), "")
    assert {r.text for r in cut.collect() if r.text} >= {prose[0], prose[3], prose[4]}


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c d e f", "en", 5, 9), (2, "a b c d e f", "de", 6, 8), (3, None, "fr", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string, row int, s long")
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
        found = stage(spark, docs, "")
        assert found.columns == docs.columns
        assert sorted(map(tuple, found.collect())) == [rows[0], rows[2]]


def test_stages_send_texts_to_workers_in_small_batches(spark, folder):
    path, _, _ = folder
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    wide = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 3000) as text").mapInArrow(sizes, "size long")
    try:
        for _, stage in corpus_pipeline.STAGES:
            if stage is corpus_pipeline.drop_copies:  # has no Python worker
                continue
            spark.conf.unset(key)
            stage(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
            assert 0 < max(r.size for r in wide.collect()) < 5 << 20, stage
        spark.conf.set(key, "1m")
        corpus_pipeline.pack_sequences(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
