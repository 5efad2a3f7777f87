import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from keystrata.llm.suffix_dedup import anchored, repeated_starts, suffix_dedup

SCHEMA = "doc_id long, text string, z string, row long, spans string"


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
        out.append((key, len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup(df, **options).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=25).map(lambda b: bytes(97 + c % 3 for c in b)), max_size=9), st.integers(1, 6))
def test_repeated_starts(pieces, length):
    seen = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
    expected = [[seen[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]
    assert [f.tolist() for f in repeated_starts(pieces, length)] == expected


def test_repeated_starts_with_all_byte_values():
    pieces = [bytes(range(256)), bytes(range(256)), bytes(range(100, 256)) + b"\x00"]
    assert [int(f.sum()) for f in repeated_starts(pieces, 50)] == [207, 207, 107]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=6), st.integers(4, 9), st.integers(1, 4))
def test_every_string_has_one_anchor(texts, length, anchor):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    owner, first, last, place, anchors, _ = anchored(data, offsets, length, anchor)
    starts = sorted((o, s) for o, a, b in zip(owner, first, last) for s in range(a, b + 1))
    assert starts == [(o, s) for o, t in enumerate(raw) for s in range(len(t) - length + 1)]
    assert all(a <= s and s + anchor <= b + length for a, b, s in zip(first, last, first + place))
    by_string = {}
    for o, a, b, h in zip(owner, first, last, anchors):
        for s in range(a, b + 1):
            assert by_string.setdefault(raw[o][s : s + length], h) == h


def sample(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join("".join(rng.choice("abcdeé日") for _ in range(rng.randrange(2, 7))) for _ in range(n))
    passage, other = prose(30), prose(12)
    texts = [prose(rng.randrange(1, 60)) for _ in range(15)]
    texts += [prose(5) + passage + prose(rng.randrange(9)) for _ in range(25)]
    texts += [other + prose(3) + other, "x" * 500, "ab " * 200, passage, passage, "", None, "short", "short"]
    texts += [passage[i : i + 45] for i in range(0, 60, 7)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(None, passage), (3, "twice" * 30), (3, None)]


@pytest.mark.parametrize(("length", "anchor", "block"), [(40, 12, 8192), (40, 12, 3), (25, 20, 5)])
def test_against_brute_force(spark, length, anchor, block):
    rows = sample(length + block)
    assert run(spark, rows, length=length, anchor=anchor, block=block) == brute(rows, length)


def test_whole_characters(spark):
    rows = sample(1)
    for r in run(spark, rows, length=41, anchor=10, whole_characters=True):
        r[3].decode()
    plain, whole = (run(spark, rows[:40], length=41, anchor=10, whole_characters=w) for w in (False, True))
    for a, b in zip(plain, whole):
        assert 0 <= len(b[3]) - len(a[3]) <= 6 * (len(a[2]) + 1)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "a" * 150)]) == [(1, 150, [], b"a" * 150)]
