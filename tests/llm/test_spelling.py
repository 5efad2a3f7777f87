import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from keystrata.llm import spelling
from keystrata.llm.spelling import cheapest_disjoint, crc32_of_runs, group_spellings

SCHEMA = "doc_id long, text string, word string, n int"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], SCHEMA)
    found = group_spellings(docs, **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()), key=repr)


def varied(rng, alphabet, word):
    k = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    return word[:k] + ("" if kind == 0 else rng.choice(alphabet)) + word[k + (kind != 1) :]


def corpus(seed, alphabet, words, docs, size):
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.randrange(7, 11))) for _ in range(words)]
    out = []
    for i in range(docs):
        picked = rng.choices(base, weights=[1 / (k + 1) ** 2 for k in range(words)], k=size)
        picked = [varied(rng, alphabet, w) if rng.random() < 0.2 else w for w in picked]
        picked = [varied(rng, alphabet, w) if rng.random() < 0.1 else w for w in picked]
        out.append((i, rng.choice(" ,.-3")[0].join(w.title() if rng.random() < 0.1 else w for w in picked)))
    return out


@pytest.mark.parametrize("alphabet, meeting", [("abcdefghijklmnopqrstuvwxyzéÿÀ×", 256), ("ab", 256), ("abé", 2), ("abcdefg", 4)])
def test_against_brute_force(spark, alphabet, meeting):
    rows = corpus(len(alphabet), alphabet, 30, 40, 60)
    rows += [(None, rows[0][1]), (3, rows[3][1]), (50, None), (51, ""), (52, "short words only"), (53, "ĀéééééééĀ" * 30)]
    expected = brute(rows)
    assert any(r[1] for r in expected) or alphabet == "ab"
    assert run(spark, rows, meeting=meeting) == expected


def test_chains_end_at_the_root(spark):
    words = [("abcdefgh", 3000), ("abcdefgi", 250), ("abcdefji", 20), ("abcdekji", 2), ("zzzzzzzz", 2)]
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(words)]
    found = {r[0]: r for r in run(spark, rows)}
    assert found == {r[0]: r for r in brute(rows)}
    assert found["abcdekji"][2] == "abcdefgh" and found["zzzzzzzz"][1:] == (None, "zzzzzzzz", 2, 0, None)


def test_empty_table_and_very_long_words(spark):
    assert run(spark, []) == []
    long = "".join(random.Random(1).choices("abc", k=5000))
    rows = [(1, f"{long} {long[:-1]} {long}x" * 1 + " " + long), (2, f"{long} {long[:-1]} {long}x"), (3, f"{long[:2000]}q{long[2001:]} " * 2)]
    assert run(spark, rows) == run(spark, rows, meeting=1) == brute(rows)


def test_many_words_with_one_part(spark):
    rng = random.Random(5)
    words = {"".join(["xq", *rng.choices("ab", k=6)]) for _ in range(60)} | {"".join([*rng.choices("ab", k=6), "xq"]) for _ in range(60)}
    rows = [(i, f"{w} {w}") for i, w in enumerate(sorted(words))]
    for meeting in (1, 8, 1000):
        assert run(spark, rows, meeting=meeting) == brute(rows)


def test_crc32_of_many_runs():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + rng.integers(0, 200, 300)
    before = np.array([zlib.crc32(str(i).encode()) for i in range(300)], np.uint32)
    assert crc32_of_runs(data, starts, ends, before).tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


def test_pivots_are_disjoint_and_cheapest():
    rng = np.random.default_rng(2)
    place = np.sort(np.array([rng.permutation(6)[:3] for _ in range(200)]), axis=1)
    weight = rng.integers(1, 9, (200, 3)).astype(float)
    for p, w, i, j in zip(place, weight, *cheapest_disjoint(place, weight)):
        costs = [w[a] + w[b] for a, b in combinations(range(3), 2) if p[b] - p[a] >= 2]
        assert p[j] - p[i] >= 2 and w[i] + w[j] == min(costs)


def test_bigrams_of_words():
    words = spelling.Spelled(pa.array(["abé", "Àz"]))
    gram, word, place = words.grams()
    assert words.sizes.tolist() == [3, 2] and word.tolist() == [0, 0, 1] and place.tolist() == [0, 1, 0]
    assert gram.tolist() == [0 * 90 + 1, 1 * 90 + 26 + 0x29, 26 * 90 + 25]
