"""Token counts: texts are encoded in batches and only the lengths come back.

An Arrow function takes its rows in slices of about equally many bytes. Texts are split at boundaries that no piece of
the tokenizer and none of its added tokens crosses: where white space follows something else. A part that is still long is split again
where a letter or number is followed by another kind of sign. The library encodes each different part of a slice once,
in batches of bounded size, and a text's count is the sum over its parts. No ids leave the function.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import strings, text_slices

#: Characters from which on a part is split again, and up to which a part's count is remembered.
LONG_PART, SHORT_PART = 1 << 16, 64
#: Characters that the library is given at once, and parts that a task remembers.
BATCH_CHARS, REMEMBERED = 1 << 18, 1 << 19

# What the byte-level pattern takes for white space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PARTS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
# Latin letters before an ASCII sign or digit end a piece, too: words are split from what follows them.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORDS = re.compile(f"[{_SPACE}]*[^{_SPACE}{_LATIN}]*[{_LATIN}]+(?=[\\x00-@\\[-`{{-\\x7f])|{_PARTS.pattern}")
_INNER = regex.compile(r"\p{L}(?=[^\p{L}\p{M}])|\p{N}(?=[^\p{N}\p{M}])")


def split_safely(text: str, added: tuple[str, ...] = (), most: int = LONG_PART) -> list[str]:
    """Parts of a text whose token counts add up to the text's, by the byte-level pattern.

    Before white space that follows another character a piece always ends, and so it does between a letter and
    another kind of sign; the piece after such a place does not look back. No part of more than ``most`` characters stays
    that has such a place outside the ``added`` tokens.
    """
    parts = (_PARTS if any(token in text for token in added) else _WORDS).findall(text)
    if len(text) <= most:
        return parts
    out = []
    for part in parts:
        while len(part) > most:
            cut = _cut(part, added, most)
            if cut is None:
                break
            out.append(part[:cut])
            part = part[cut:]
        out.append(part)
    return out


def _cut(part: str, added: tuple[str, ...], most: int) -> int | None:
    """The first place from ``most`` on where a letter or number ends; never within or next to an added token."""
    for found in _INNER.finditer(part, most - 1):
        cut = found.end()
        near = [(part.find(token, max(0, cut - len(token))), len(token)) for token in added]
        if not any(0 <= at <= cut for at, _ in near):
            return cut
    return None


class Counter:
    """Token counts of texts by a tokenizer file; ``.json`` is read by tokenizers, ``.model`` by sentencepiece.

    Texts are split only for byte-level files without a normalizer, whose pattern is known. Others see whole texts.
    """

    def __init__(self, path: str):
        self.known: dict[str, int] = {}
        self.added: tuple[str, ...] = ()
        self.splits = False
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self._lengths = lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._lengths = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as lines:
            described = json.load(lines)
        before, tokens = described.get("pre_tokenizer") or {}, described.get("added_tokens") or []
        self.added = tuple(t["content"] for t in tokens)
        self.splits = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not described.get("normalizer")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or regex.search(r"\s", t["content"]) for t in tokens)
        )

    def _encoded(self, texts: list[str]) -> list[int]:
        """Lengths of texts in their order; the library gets them in batches of about ``BATCH_CHARS`` characters."""
        by = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        out, batch, chars = [0] * len(texts), [], 0
        for turn, i in enumerate(by, start=1):
            batch.append(i)
            chars += len(texts[i])
            if chars >= BATCH_CHARS or turn == len(by):
                for j, n in zip(batch, self._lengths([texts[j] for j in batch])):
                    out[j] = n
                batch, chars = [], 0
        return out

    def __call__(self, texts: list[str]) -> np.ndarray:
        if not self.splits:
            return np.array(self._encoded(texts), np.int64)
        counts = np.zeros(len(texts), np.int64)
        parts = [split_safely(text, self.added) for text in texts]
        new = list(set().union(*parts).difference(self.known)) if parts else []
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(set().union(*parts))
        self.known.update(zip(new, self._encoded(new)))
        count = self.known.__getitem__
        for i, mine in enumerate(parts):
            counts[i] = sum(map(count, mine))
        for part in new:  # long parts seldom come again
            if len(part) > SHORT_PART:
                del self.known[part]
        return counts


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the library's plain call without begin, end or added special tokens; a special token that
    stands in a text counts as the library takes it by default. Nothing is cut off or padded, and whole texts count. A
    NULL text counts as empty and has no token. Ids may be NULL or repeat; other columns are not read, whatever
    their names. An empty table gives an empty result. The file must lie at ``tokenizer_path`` on every executor.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for part in text_slices(batches, "text"):
            size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            counts = pa.array(counter(strings(part.column("text"))))
            yield pa.RecordBatch.from_arrays([part.column("id"), size, counts], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    counted = rows.mapInArrow(work, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
