import re

from keystrata.llm.licenses import PHRASES, scan_licenses

TEXTS = [
    None, "", "Released under the MIT license.", "under the mit licenses", "UNDER,the\nMIT---License under the mit license", "cc by nc by nc cc-BY-NC 4.0",
    "apache license, version 2.0", "Apache License Version é2", "licensed under the gnu general public license, version 3.", "under the under the mit license mit",
    "é under the mit license é", "x " * 30_000 + "cc by nc", "mit " * 5_000, "general public license version 3 gnu", "license", "by by cc by nc",
    "Licensed under CC BY-SA 4.0", "under the mit license apache license version 2 " * 50, "gnu general public license version 3",
]


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    hits = [(i, label) for label, phrase in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_against_brute_force(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, TEXTS[2], None, None), (4, TEXTS[2], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, row string")
    got = scan_licenses(df).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(map(str, ((k, *brute(t)) for k, t, _, _ in rows)))
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 4)}
    assert by_id[8].labels == "gpl-3" and by_id[16].labels == "cc-by-sa" and by_id[14].labels == "" and by_id[13].labels == ""


def test_native_and_empty(spark, plan_of):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = scan_licenses(df)
    assert found.collect() == []
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan_of(found))
