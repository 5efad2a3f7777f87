import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keystrata.llm import lm_scoring
from keystrata.llm.lm_scoring import ORDER, Automaton, BlockAutomaton, _ngrams, score, spelled
from keystrata.llm.words import Words

SCHEMA = "doc_id long, text string, trains boolean, score string, block long"


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def symbols(text):
    return b"".join(w.replace(b"\0", b"\1") + b" " for w in tokens(text)) + b"\0"


def witten_bell(train):
    """Function from (context, symbol) to probability, by the definition."""
    counts = {}
    for t in train:
        s = b" " * (ORDER - 1) + symbols(t)
        for i in range(ORDER - 1, len(s)):
            for k in range(ORDER):
                counts.setdefault(s[i - k : i], Counter())[s[i : i + 1]] += 1

    def p(context, x):
        if context and context not in counts:
            return p(context[1:], x)
        lower = p(context[1:], x) if context else 1 / 256
        n = counts.get(context)
        return (n[x] + len(n) * lower) / (n.total() + len(n)) if n else lower

    return p


def brute(rows):
    train = [t for _, t, f in rows if f]
    count = Counter(w for t in train for w in tokens(t))
    ends = len(train)
    n, v = count.total() + ends, len(count) + (ends > 0)
    p = witten_bell(train)
    out = []
    for key, t, f in rows:
        words = tokens(t)
        cs = [count[w] for w in words] + [ends]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in cs)
        s = b" " * (ORDER - 1) + symbols(t)
        whole = sum(math.log10(p(s[i - ORDER + 1 : i], s[i : i + 1])) for i in range(ORDER - 1, len(s)))
        out.append((str(key), bool(f), len(words) + 1, sum(c > 0 for c in cs), n, round(base, 5), round(whole, 2)))
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, f, "x", 1) for i, t, f in rows], SCHEMA)
    found = score(df, F.col("trains"), **options).collect()
    return sorted((str(r.doc_id), r.trains, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 2)) for r in found)


def same(got, expected):
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5] == pytest.approx(e[5], abs=2e-5) and g[6] == pytest.approx(e[6], abs=0.05 + 1e-5 * abs(e[6]))


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choice(["ab", "ca", "é", "Th", "e"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, prose(rng.randrange(40)), i % 3 > 0) for i in range(40)]
    rows += [(100, None, True), (101, "", False), (None, "the\x00 end\t\n x", True), (102, prose(2500), False), (102, "unseen zzz", None), (103, " \n ", True)]
    same(run(spark, rows, block_bytes=block_bytes), brute(rows))


def test_without_training_texts_and_empty(spark):
    rows = [(1, "a b", False), (2, None, False)]
    same(run(spark, rows), brute(rows))
    assert run(spark, []) == []


def test_probabilities_add_up_and_arcs_follow_the_longest_context():
    arcs = {b"": {97: 5, 32: 3, 0: 1}, b"a": {97: 2, 32: 1}, b"aa": {32: 2}, b" ": {97: 2}}
    model = Automaton.of_counts(arcs)
    shares = 10 ** model.weight.astype(float)
    columns = np.bincount(model.symbol_of, minlength=shares.shape[1])
    assert np.allclose(shares @ columns, 1, atol=1e-5)
    for i, context in enumerate(model.contexts):
        for x in (97, 32, 0):
            history = context + bytes([x])
            longest = next(history[k:] for k in range(len(history) + 1) if history[k:] in model.contexts)
            assert model.contexts[model.follow[i, model.symbol_of[x]]] == longest


def test_spelling():
    raw = [b" Ab\tc", b"", b"x", b"\n"]
    out, offsets = spelled(Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    assert [out[a:b].tobytes() for a, b in zip(offsets, offsets[1:])] == [b"ab c \0", b"\0", b"x \0", b"\0"]


def test_contexts_stay_whatever_the_size_of_the_corpus(spark):
    """A word of 2 in 40,000 symbols and more is still known by its longest contexts."""
    rare = "qvxzkj wyqxvz"
    texts = ["ab cd ef " * 5000] * 3 + [rare] * 2
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(10, rare, False)]
    counts = {}
    for t in texts:
        s = b" " * (ORDER - 1) + symbols(t)
        for i in range(ORDER - 1, len(s)):
            for k in range(ORDER):
                counts.setdefault(s[i - k : i], Counter())[s[i]] += 1
    model = Automaton.of_counts(counts)
    raw = symbols(rare)
    expected = model.score(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), model.start)[0]
    found = {r.doc_id: r.score for r in score(spark.createDataFrame([(i, t, f, "x", 1) for i, t, f in rows], SCHEMA), F.col("trains"), block_bytes=5000).collect()}
    assert found[10] == pytest.approx(expected, abs=0.01) and found[10] == pytest.approx(found[3], abs=1e-6)


def test_a_blocks_automaton_walks_as_the_whole_one():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abé", k=rng.randrange(1, 9))) for _ in range(rng.randrange(900))) for _ in range(12)] + ["", "x"]
    counts = {}
    for t in texts[:6]:
        s = b" " * (ORDER - 1) + symbols(t)
        for i in range(ORDER - 1, len(s)):
            for k in range(ORDER):
                counts.setdefault(s[i - k : i], Counter())[s[i]] += 1
    whole = Automaton.of_counts(counts)
    raw = [symbols(t) for t in texts]
    path, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    grams = np.unique(_ngrams(path, offsets))

    def weight(gram):
        state = 0
        for x in int(gram).to_bytes(ORDER, "big"):
            last, state = state, whole.follow[state, whole.symbol_of[x]]
        return whole.weight[last, whole.symbol_of[x]]

    block = BlockAutomaton(grams, np.array([weight(g) for g in grams]))
    assert max(map(len, raw)) > 2 * lm_scoring._SEGMENT
    assert np.allclose(block.score(path, offsets), whole.score(path, offsets, whole.start), rtol=1e-5)


def test_blocks_are_scored_by_their_automata(spark, monkeypatch):
    """The query's path goes through the traversal: the tasks see a changed one, too, as its function travels with them."""
    walked = []
    score_path = BlockAutomaton.score
    monkeypatch.setattr(BlockAutomaton, "score", lambda self, *a: walked.append(len(self.contexts)) or score_path(self, *a))
    import pyarrow as pa

    texts = pa.table({"id": [1, 2], "text": ["ab ab", "b"], "trains": [True, False], "block": [0, 0]})
    asked = lm_scoring._asked(1)(texts)
    grams = np.frombuffer(asked.column("grams")[0].as_py(), np.uint64)
    sent = pa.table({"word": pa.array([None], pa.int64()), "c": pa.array([0], pa.int64()), "leads": [False], "bucket": [0], "weights": pa.array([np.full(len(grams), -1, "<f4").tobytes()])})
    found = lm_scoring._block_scores(1)(None, texts, sent)
    assert walked and found.column("score").to_pylist() == [-7.0, -3.0]


def test_long_words_are_told_apart(spark):
    """Two words for which a sum of powers modulo 2 ** 64 is the same."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one + " x", True), (2, other + " x", False)]
    same(run(spark, rows), brute(rows))


def test_rows_that_repeat_whole_are_spread_over_blocks(spark, monkeypatch):
    rows = [(None, "the same text " * 10, True)] * 200
    found = []
    placed = lm_scoring.placed
    monkeypatch.setattr(lm_scoring, "placed", lambda *a: found.append(placed(*a)) or found[-1])
    same(run(spark, rows, block_bytes=7000), brute(rows))
    per_block = Counter(r.block for r in found[0].select("block").collect())
    assert len(per_block) == 4 and max(per_block.values()) < 100


def test_ngrams_are_counted_in_little_room_and_sent_in_parts():
    rng = np.random.default_rng(5)
    texts = [rng.integers(32, 127, 4096, np.uint8).tobytes().decode() for _ in range(1024)]
    trains = [i % 10 > 0 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(trains)], names=["text", "trains"])
    tracemalloc.start()
    try:
        parts = list(lm_scoring._count(iter([batch])))
        held = sum(p.nbytes for p in parts)
        assert tracemalloc.get_traced_memory()[1] - held < 64 << 20
    finally:
        tracemalloc.stop()
    assert max(p.num_rows for p in parts) <= 1 << 17
    assert sum(sum(p.column("n").to_pylist()) for p in parts) == sum(len(symbols(t)) for t, f in zip(texts, trains) if f)
