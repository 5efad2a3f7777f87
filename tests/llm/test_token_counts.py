import public_tokenizers as public
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from keystrata.llm import token_counts
from keystrata.llm.token_counts import Counter, count_tokens, split_safely

JSON = public.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)
HARD = [
    "", " ", "  ", "\n", " \n ", "a  b", "a \n b\n\n", "don't we'll I'M 'tis 'sx !'s ''s  's \n's x'relic they'velo 'l 'll", "é 　 ü ß\x1c\x1d a", "　　  a", "a᠎ b",
    "1234 5a6 ٣٤ ½", "日本語 テキスト 한국어", "👩‍👩‍👧 ok", "<|endoftext|>", "a<|endoftext|>b <|endoftext|> c", "<|endoftext|", "<|endoftext|><|endoftext|>", " <|endoftext|>\n", "\x00\x01 tab\tend",
    "éé x́! a​b",
]


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def plain(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_are_the_librarys(library):
    assert Counter(JSON)(HARD).tolist() == [plain(library, t) for t in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t'<|>endofxts12!é́　\xa0日。"), max_size=40), max_size=4))
def test_random_texts(texts):
    library = LIBRARY
    assert token_counts._counter(JSON)(texts).tolist() == [plain(library, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(" '<|>endofxts12!é́日。Я×"), max_size=60))
def test_parts_add_up(text):
    library = LIBRARY
    parts = split_safely(text + "<|endoftext|>" + text, ("<|endoftext|>",), most=3)
    assert "".join(parts) == text + "<|endoftext|>" + text
    assert sum(plain(library, p) for p in parts) == plain(library, "".join(parts))


def test_long_texts_are_split_and_counted_whole(library):
    texts = ["日本語、" * 60_000, "x" * 200_000, "word " * 100_000, "a1" * 50_000 + "<|endoftext|>" * 3000]
    assert max(map(len, split_safely(texts[0]))) <= token_counts.LONG_PART + 4
    assert Counter(JSON)(texts).tolist() == [plain(library, t) for t in texts]


def test_a_full_memory_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    counter = Counter(JSON)
    for texts in (["a b c d"], ["e f g h", "a b"], ["a " * 9]):
        assert counter(texts).tolist() == [plain(library, t) for t in texts]
    assert len(counter.known) <= 5


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_see_whole_texts(file):
    counter = Counter(public.path(file))
    assert not counter.splits
    texts = ["Hello  World", "", "x y z"]
    if file.endswith(".json"):
        library = Tokenizer.from_file(public.path(file))
        assert counter(texts).tolist() == [plain(library, t) for t in texts]
    else:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=public.path(file))
        assert counter(texts).tolist() == [len(library.encode(t)) for t in texts]


def test_rows(spark, library):
    rows = [(1, "one two"), (1, "one two"), (None, "é"), (2, None), (3, ""), (4, "word " * 600)]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_tokens int, id string")
    found = count_tokens(docs, JSON)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, len((t or "").encode()), plain(library, t or ""), plain(library, t or "") > 512) for i, t in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert count_tokens(docs.limit(0), JSON).collect() == []
