import base64
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from keystrata.llm.byte_bpe import ByteBPE, decode, encode
from keystrata.llm.packing import BestFit, pack
from keystrata.llm.pretokens import CachedEncoder, Pieces

RANKS = public.path("byte_bpe_multi_50k.tiktoken")
JSON = public.path("byte_bpe_50k.json")
HARD = [
    "", " ", "  ", "\n", " \n ", "a  b", "a \n b\n\n", "don't we'll I'M 'tis 'sx !'s ''s  's \n's x'relic they'velo 'l 'll", "x" * 3000,
    "é 　 ü ß\x1c\x1d a", "1234 5a6 ٣٤ ½", "日本語 テキスト 한국어", "👩‍👩‍👧 ok", "<|endoftext|> <|im_start|>", "\x00\x01 tab\tend", "ab" * 700 + " " * 90 + "c",
]
SPECIAL = ["a<|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n x", "it<|endoftext|>'s  <|endoftext|", "don't<|endoftext|>  ", "x " * 400 + "<|endoftext|>" * 3 + " y"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE.from_file(RANKS)


def split(texts):
    found = Pieces(texts)
    out = [[] for _ in texts]
    for i, k in enumerate(found.text_of):
        out[k].append(found.piece(i))
    return out


def test_pieces_are_those_of_the_pattern():
    rust = regex.compile(public.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"[^\p{White_Space}", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    assert split(HARD) == [rust.findall(t) for t in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab's tlrevmd 12.,!\n\t é日½ ")), max_size=30), max_size=5))
def test_encoding_is_that_of_the_library(texts):
    bpe, library = _state()
    ids, offsets = CachedEncoder(bpe.encode_pieces)(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode_ordinary(t) for t in texts]


_cached = []


def _state():
    if not _cached:
        with open(RANKS, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _cached.append((ByteBPE.from_file(RANKS), tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})))
    return _cached[0]


def test_hard_texts_and_small_cache(bpe, library):
    small = CachedEncoder(bpe.encode_pieces, most=5)
    for _ in range(2):
        ids, offsets = small(HARD)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode_ordinary(t) for t in HARD]


def test_encode_and_decode_frames(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(HARD)] + [(None, "a b", None), (3, None, "y"), (3, "\n", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = encode(df, RANKS, decoded=True).collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in found) == sorted((str(i), library.encode_ordinary(t or "")) for i, t, _ in rows)
    assert sorted(bytes(r.decoded) for r in found) == sorted((t or "").encode() for _, t, _ in rows)
    again = decode(encode(df, RANKS), RANKS).collect()
    assert sorted(bytes(r.decoded) for r in again) == sorted((t or "").encode() for _, t, _ in rows)
    assert encode(df.limit(0), RANKS).collect() == []


def test_packing(spark):
    words = [" ".join(["word", "hé", "12"][i % 3] for i in range(n)) for n in (0, 1, 5, 700, 1022, 1023, 1024, 3000, 40, 90, 300)]
    rows = [(i, t, 0) for i, t in enumerate([*words, *HARD])] + [(None, None, 1), (5, "twice", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int").coalesce(2)
    tokenizer = Tokenizer.from_file(JSON)
    assert tokenizer.encode("a<|endoftext|> b", add_special_tokens=False).ids[1] == 50256
    rows += [(200 + i, t, 0) for i, t in enumerate(SPECIAL)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int").coalesce(2)
    expected = sorted(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t, _ in rows)
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in pack(df, JSON, open_bins=4).collect():
        assert len(r.tokens) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.piece, r.start, r.length, bytes(r.tokens)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    for key, pieces in documents.items():
        if key != 5:  # that id is there twice
            pieces.sort()
            assert [p[0] for p in pieces] == list(range(len(pieces)))
            assert [p[1] for p in pieces] == [sum(q[2] for q in pieces[:k]) for k in range(len(pieces))]
            assert all(p[2] == 1024 for p in pieces[1:])
    whole = [b"".join(p[3] for p in sorted(v)) for k, v in documents.items() if k != 5] + [p[3] for p in documents[5] if p[2] < 100]
    assert sorted(w for w in whole) == sorted(e for e in expected if len(e) in {len(x) for x in whole})[: len(whole)] or set(whole) <= set(expected)
    for i, t in enumerate(SPECIAL):
        assert b"".join(p[3] for p in sorted(documents[200 + i])) == np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()
    assert pack(df.limit(0), JSON).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 9))
def test_bins_are_bounded_and_never_overfull(lengths, open_bins):
    fit, filled = BestFit(50, open_bins), defaultdict(int)
    for n in lengths:
        number, offset = fit.place(n)
        assert offset == filled[number]
        filled[number] += n
        assert filled[number] <= 50 and fit.count <= open_bins
        assert sum(map(len, fit.bins)) == fit.count and all(bool(b) == bool(fit.free >> f & 1) for f, b in enumerate(fit.bins))
