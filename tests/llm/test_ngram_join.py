import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from keystrata.llm.components import components
from keystrata.llm import ngram_join as module
from keystrata.llm.ngram_join import Shingles, ngram_join, prefix

SCHEMA = "doc_id long, text string, n long, s long, component string"


def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute(rows, k, above):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and above[1] * both >= above[0] * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [k for j, (k, _) in enumerate(rows) if find(j) == find(i) and k is not None]
        out.append((key, len(sets[i]), key if not sets[i] else min(ids, default=None)))
    return sorted(out, key=str)


def run(spark, rows, k, above, **options):
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in ngram_join(df, k, above, **options).collect()), key=str)


def family(rng, size, copies, changes):
    base = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(size)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(size)] = "new" + str(rng.randrange(10**6))
        out.append(" ".join(words))
    return out


def sample(seed):
    rng = random.Random(seed)
    texts = family(rng, 120, 40, 3) + family(rng, 60, 30, 2) + family(rng, 12, 20, 1) + family(rng, 400, 12, 30)
    passage = " ".join("p" + str(i) for i in range(40))
    texts += [passage + " " + t for t in family(rng, 50, 1, 0) * 3 + [" ".join(family(rng, 50, 1, 0)) for _ in range(20)]]
    texts += ["", None, " \n ", "A b", "a  B", "one", "One", "é é é", "w " * 20_000, "w " * 19_000]
    texts += rng.sample(texts, 30)
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("k", "above", "frequent_from"), [(3, (90, 100), 1000), (3, (90, 100), 8), (5, (80, 100), 15), (3, (1, 2), 5)])
def test_against_brute_force(spark, k, above, frequent_from):
    rows = sample(k)
    assert run(spark, rows, k, above, frequent_from=frequent_from) == brute(rows, k, above)


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "x y z q"), (7, None), (None, "")]
    assert run(spark, rows, 5, (80, 100)) == brute(rows, 5, (80, 100))
    assert run(spark, [], 5, (80, 100)) == []


def test_sizes_of_sets():
    texts = ["a b c a b c a b c", "a b", "A B", "", "x", "a b c"]
    raw = [t.encode() for t in texts]
    found = Shingles(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 3)
    assert found.sizes.tolist() == [3, 1, 1, 0, 1, 1]
    assert found.hashes[3] == found.hashes[4]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=25), st.integers(1, 10), st.data())
def test_prefixes_meet(kinds, need, data):
    """Two sets with at most need - 1 shingles of each missing in the other share a rare one or two frequent ones."""
    low = sorted((not a for a, _ in kinds))
    is_low = np.array([not v for v in low])
    is_hot = np.array([h for _, h in kinds]) & is_low
    mine = np.array(sorted(data.draw(st.sets(st.integers(0, len(kinds) - 1), min_size=1))))
    drop = data.draw(st.sets(st.sampled_from(mine.tolist()), max_size=need - 1))
    add = data.draw(st.sets(st.integers(0, len(kinds) - 1), max_size=need - 1)) - set(mine.tolist())
    other = np.array(sorted((set(mine.tolist()) - drop) | add), dtype=int)
    if not len(other) or len(mine) < need or len(other) < need or not set(mine) & set(other):
        return
    found = []
    for s in (mine, other):
        rare, hot = prefix(is_hot[s], is_low[s], need)
        found.append((set(s[rare]), set(s[hot]), len(rare) + max(0, len(hot) - 1)))
    if all(f[2] >= need for f in found):
        assert found[0][0] & found[1][0] or len(found[0][1] & found[1][1]) >= 2


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 11), (5, 5), (20, 1), (2, 1)] + [(100 + i, 101 + i) for i in range(40)] + [(1000, i) for i in range(1001, 1100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {1: 1, 2: 1, 3: 1, 20: 1, 8: 8, 9: 8, 10: 8, 11: 8} | {100 + i: 100 for i in range(41)} | {1000 + i: 1000 for i in range(100)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=25), st.integers(1, 10), st.data())
def test_prefixes_meet_when_frequent_shingles_are_anywhere(kinds, need, data):
    low = sorted(not a for a, _ in kinds)
    is_low, is_hot = np.array([not v for v in low]), np.array([h for _, h in kinds])
    mine = np.array(sorted(data.draw(st.sets(st.integers(0, len(kinds) - 1), min_size=1))))
    drop = data.draw(st.sets(st.sampled_from(mine.tolist()), max_size=need - 1))
    add = data.draw(st.sets(st.integers(0, len(kinds) - 1), max_size=need - 1)) - set(mine.tolist())
    other = np.array(sorted((set(mine.tolist()) - drop) | add), dtype=int)
    found = [(s, *prefix(is_hot[s], is_low[s], need)) for s in (mine, other) if len(s) > need]
    for s, rare, hot in found:
        assert len(rare) + max(0, len(hot) - 1) >= need
        assert not is_hot[s[rare]].any() and is_hot[s[hot]].all()
    if len(found) == 2:
        (s, a, b), (t, c, d) = found
        assert set(s[a]) & set(t[c]) or len(set(s[b]) & set(t[d])) >= 2


def test_a_frequent_shingle_above_the_border_is_not_indexed_alone():
    """Sets of one template, none of whose shingles is in the low part of the hash range."""
    part, lack, sets = 0.16, (10, 100), 3 * module.MEETING
    template = np.sort(np.random.default_rng(1).integers(1 << 62, 1 << 63, 20).astype(np.uint64))
    order = [template[:4].tobytes()] * sets
    batch = pa.RecordBatch.from_arrays([pa.array(range(sets)), pa.array([20] * sets), pa.array(order, pa.binary())], names=["s", "n", "order"])
    counted = next(iter(module._counted([batch])))
    many = np.asarray(counted.column("n")) >= module.FREQUENT
    frequent = SimpleNamespace(value=(np.asarray(counted.column("token"))[many].view(np.uint64), np.asarray(counted.column("n"))[many]))
    index = next(iter(module._index(frequent, part, lack)([batch])))
    _, met = np.unique(np.stack([np.asarray(index.column(c)) for c in ("signature", "block")]), axis=1, return_counts=True)
    assert met.max() < 2.5 * module.MEETING
    rows = set(zip(*(index.column(c).to_pylist() for c in ("signature", "block", "s"))))
    places = [{(x, y) for x, y, s in rows if s == i} for i in (0, 1, 5000, sets - 1)]
    assert all(a & b for a in places for b in places)


def test_large_meetings_of_rare_shingles_are_dealt(spark):
    rows = [(1, module.ALONE, s, 40) for s in range(40)] + [(2, module.ALONE, s, 5) for s in range(5)] + [(3, 0, s, 30) for s in range(30)]
    found = module.dealt(spark.createDataFrame(rows, "signature long, block long, s long, m long"), most=10).collect()
    places = {}
    for r in found:
        places.setdefault((r.signature, r.block), set()).add(r.s)
    assert max(len(v) for (k, _), v in places.items() if k == 1) < 40
    assert all(any({a, b} <= v for (k, _), v in places.items() if k == 1) for a in range(40) for b in range(40))
    assert places[2, module.ALONE] == set(range(5)) and places[3, 0] == set(range(30))


def test_small_sets_of_frequent_shingles(spark):
    rows = [(i, t) for i, t in enumerate(["a", "b", "a b", "c"] + [f"a x{j}" for j in range(8)] + [f"a b y{j}" for j in range(8)])]
    assert run(spark, rows, 1, (1, 2), frequent_from=3) == brute(rows, 1, (1, 2))


def test_long_words_are_told_apart(spark):
    """Two words for which a sum of powers modulo 2 ** 64 is the same."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one + " x y"), (2, other + " x y"), (3, one + " x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join(docs, k=3, above=(90, 100)).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_chance_meetings_of_other_sizes_lose_no_link(spark):
    """Many sets of all sizes share a few shingles; only those of like size can be similar."""
    rng = random.Random(11)
    common = " ".join(f"c{i}" for i in range(12))
    rows = []
    for i in range(60):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 150)))
        rows.append((i, f"{common} {own}"))
        if i % 3 == 0:
            rows.append((100 + i, f"{common} {own} end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for above in ((90, 100), (80, 100)):
        found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs, k=3, above=above, frequent_from=8).collect())
        assert found == sorted(brute(rows, 3, above))


def test_a_large_group_around_a_text_that_fails_is_not_paired_out(spark, monkeypatch):
    """All of the group may be similar to its first text, by their parity bits, but none is: others link them."""
    base = [f"t{i}" for i in range(600)]
    outlier = [f"o{i}" if i % 45 == 5 and i < 585 else w for i, w in enumerate(base)]
    rows = [(0, " ".join(outlier))] + [(i, " ".join(base[: i * 9] + [f"n{i}"] + base[i * 9 + 1 :])) for i in range(1, 60)]
    seen = {}

    def counting(df, name):
        out = module_written(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    module_written = module.written
    monkeypatch.setattr(module, "written", counting)
    assert run(spark, rows, 5, (80, 100)) == brute(rows, 5, (80, 100))
    assert seen["ngram-join-more"][0] <= len(rows) and len(seen["ngram-join-forest"]) > 1


def test_turns_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "MANY_PAIRS", 0)
    for k, above in ((5, (80, 100)), (3, (1, 2))):
        assert run(spark, sample(k + 7), k, above, frequent_from=15) == brute(sample(k + 7), k, above)


def test_all_pairs_of_a_large_meeting_are_sent_in_parts():
    n = 600
    columns = {"signature": np.zeros(n, np.int64), "block": np.zeros(n, np.int64), "s": np.arange(n), "n": np.full(n, 50), "c": np.arange(n)}
    batch = pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), pa.array([bytes(module.SKETCH_BITS // 8)] * n, pa.binary())], names=[*columns, "bits"])
    parts = list(module._meetings((80, 100), forest=False)(iter([batch])))
    assert max(p.num_rows for p in parts) < (1 << 16) + n
    found = {(a, b) for p in parts for a, b in zip(p.column("a").to_pylist(), p.column("b").to_pylist())}
    assert found == {(a, b) for a in range(n) for b in range(a + 1, n)} and sum(p.num_rows for p in parts) == len(found)


def test_short_texts_take_little_room():
    n = 10_000
    texts = ["" if i % 7 == 0 else f"w{i} common w{i % 5} of a text {'' if i % 2 else 'more'}" for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([""] * n), pa.array(texts)], names=["id", "h", "text"])
    work = module._sets(5, 0.32, (20, 100))
    tracemalloc.start()
    try:
        got = [bits for part in work(iter([batch])) for bits in part.column("bits").to_pylist()]
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()
    for text, bits in zip(texts, got, strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        odd = np.bincount((Shingles(raw, np.array([0, len(raw)]), 5).hashes & np.uint64(module.SKETCH_BITS - 1)).astype(np.int64), minlength=module.SKETCH_BITS) & 1
        assert np.packbits(odd.astype(np.uint8)).tobytes() == bits


@pytest.mark.parametrize("few", [4, 0])
def test_a_large_group_of_small_classes_is_compared_once(spark, monkeypatch, few):
    """Sets of a group meet at all pairs of its shingles; those that are alike in twos or threes need no further rounds."""
    rng = random.Random(5)
    base = [f"t{i}" for i in range(160)]
    rows = []
    for i in range(40):
        own = [f"n{i}-{j}" if j in places else w for places in [rng.sample(range(160), 8)] for j, w in enumerate(base)]
        rows += [(3 * i, " ".join(own)), (3 * i + 1, " ".join([*own, "end"]))] + [(3 * i + 2, " ".join(["first", *own]))] * (i % 2)
    seen = {}

    def counting(df, name):
        out = module_written(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    module_written = module.written
    monkeypatch.setattr(module, "written", counting)
    monkeypatch.setattr(module, "MANY_PAIRS", few)
    assert run(spark, rows, 5, (80, 100), frequent_from=8) == brute(rows, 5, (80, 100))
    if few:
        assert sum(seen["ngram-join-apart"]) == 0
    else:  # all meetings hold back what they have; their sets meet by single shingles then
        assert 0 < 3 * seen["ngram-join-together"][0] < seen["ngram-join-apart"][0]
