import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from keystrata.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, h string, n string, keep_id string, source string"


def brute(rows, best):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for key, text in rows:
        ids = [k for k in groups[text or ""] if k is not None]
        keep = best(ids) if ids else None
        out.append((key, keep, len(groups[text or ""]), key == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(k, t, "x", "y", "z", None) for k, t in rows], SCHEMA)
    return sorted((tuple(r) for r in exact_dedup(df, **options).collect()), key=str)


ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "é" * 50_000), (6, "é" * 50_000), (None, "a"), (7, "A"), (None, "q"), (8, "b"), (8, "b")]


def test_against_brute_force(spark):
    for keep, best in (("min", min), ("max", max)):
        assert run(spark, ROWS, keep=keep) == brute(ROWS, best)


def test_equal_hashes_of_different_texts(spark):
    for weak in (lambda c: F.lit("same"), lambda c: F.substring(F.md5(c), 1, 1)):
        assert run(spark, ROWS, hashed=weak) == brute(ROWS, min)


def test_empty(spark):
    assert run(spark, []) == []
