"""Toxicity by class-conditional Kneser-Ney models.

A text's words are spelled byte by byte by two models, one of toxic and one of ordinary texts. Each knows how often
its class goes on in which way after the word so far, and backs off to one model of all labelled texts: first after
the same beginning of the word, then by Kneser-Ney continuation counts of shorter runs of bytes. An expression that
neither class knows well so costs both alike. The length-normalised difference of the two log-likelihoods, whole
and as far as it comes from single telling words, becomes a score by a logistic curve, which is fitted on labelled
texts whose counts are not in the models.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import strings, text_slices
from keystrata.llm.words import Words, mixed, power

ORDER = 5  # bytes of the shared runs, the predicted one included
DISCOUNT = 0.75
TRUST = 5.0  # counts of its own that a class needs after some beginning to weigh as much as all texts
TELLING = 3.0  # a word tells when its log-likelihoods differ by more
CALIBRATION = 5  # one labelled text of so many is kept for the logistic curve
_WORD_BYTES = 64  # a longer word is spelled in parts of this size
_SCORED_BYTES = 512 << 10  # texts scored at once: some hundred bytes of numbers are held for each of these


def _bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _parts(word: bytes) -> list[bytes]:
    """The word in parts of at most _WORD_BYTES, cut before whole characters."""
    parts, at = [], 0
    while at < len(word):
        end = at + _WORD_BYTES
        if end < len(word):
            while end > at + _WORD_BYTES - 4 and word[end] & 0xC0 == 0x80:
                end -= 1
        parts.append(word[at:end])
        at = end
    return parts


def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, each between blanks, and how many bytes of its word stand before each place."""
    data = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    return data, np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` bytes up to each place, packed into 64 bits."""
    packed = np.zeros(len(data), np.uint64)
    for k in range(min(order, len(data))):
        packed[k:] |= data[: len(data) - k].astype(np.uint64) << np.uint64(8 * k)
    return packed


def _beginnings(data: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Hash of each word from its first blank up to each place."""
    up, down = power(len(data))
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])
    start = np.arange(len(data)) - depth
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    return mixed((sums - before) * down[start])


@dataclass
class ToxicityModel:
    """``begun``: sorted hashes of word beginnings; their counts and numbers of different continuations, for
    ordinary texts, toxic texts and all. ``runs``: per order, sorted runs of bytes with their share after their
    context and their own backoff weight."""

    begun: np.ndarray
    counts: np.ndarray  # (3, beginnings)
    kinds: np.ndarray  # (3, beginnings)
    runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    @classmethod
    def of_counts(cls, k: np.ndarray, gram: np.ndarray, parent: np.ndarray, n: np.ndarray) -> ToxicityModel:
        """``n``: (2, rows) counts in ordinary and toxic texts; k is 0 for beginnings, else the order of a run."""
        at = np.flatnonzero(k == 0)
        at = at[np.argsort(gram[at])]
        begun = gram[at]
        counts = np.concatenate([n[:, at], n[:, at].sum(axis=0, keepdims=True)]).astype(np.float64)
        place, known = _find(begun, parent[at])
        kinds = np.zeros_like(counts)
        for side in range(3):
            np.add.at(kinds[side], place[known], np.minimum(counts[side][known], 1.0))
        tables = []
        for order in range(1, ORDER + 1):
            at = np.flatnonzero(k == order)
            at = at[np.argsort(gram[at])]
            tables.append((gram[at], n[:, at].sum(axis=0).astype(np.float64)))
        for order in range(ORDER - 1, 0, -1):  # continuation counts: how many different bytes stand before a run
            keys, raw = tables[order - 1]
            place, known = _find(keys, tables[order][0] & np.uint64((1 << 8 * order) - 1))
            spread = np.bincount(place[known], minlength=len(keys)).astype(np.float64)
            tables[order - 1] = (keys, np.where(spread > 0, spread, raw))  # a word's start has nothing before it
        runs, back = [], [np.ones(len(keys)) for keys, _ in tables]
        for order, (keys, c) in enumerate(tables, 1):
            if order == 1:
                share = c * 0.999 / max(c.sum(), 1)
            else:
                place, known = _find(tables[order - 2][0], keys >> np.uint64(8))
                size = len(tables[order - 2][0])
                total = np.bincount(place[known], weights=c[known], minlength=size)
                different = np.bincount(place[known], minlength=size)
                back[order - 2] = np.where(total > 0, DISCOUNT * different / np.maximum(total, 1), 1.0)
                share = np.where(known, np.maximum(c - DISCOUNT, 0) / np.maximum(total[place] if size else 1, 1), 0)
            runs.append((keys, share, back[order - 1]))
        return cls(begun, counts, kinds, [(keys, share, back[i]) for i, (keys, share, _) in enumerate(runs)])

    def word_differences(self, words: list[bytes]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word."""
        data, depth = _spelled(words)
        p = np.full(len(data), 0.001 / 256)
        back = np.ones(len(data))
        for order, (keys, share, weight) in enumerate(self.runs, 1):
            place, known = _find(keys, _grams(data, order))
            known &= depth >= order - 1
            before = np.ones(len(data))
            before[1:] = back[:-1]
            before[depth < order - 1] = 1.0
            p = p * (before if order > 1 else 1.0) + (np.where(known, share[place], 0) if len(keys) else 0)
            back = np.where(known, weight[place], 1.0) if len(keys) else np.ones(len(data))
        place, known = _find(self.begun, _beginnings(data, depth))
        found = np.where(known, self.counts[:, place], 0) if len(self.begun) else np.zeros((3, len(data)))
        kinds = np.where(known, self.kinds[:, place], 0) if len(self.begun) else np.zeros((3, len(data)))
        total, different = np.zeros_like(found), np.zeros_like(kinds)
        total[:, 1:], different[:, 1:] = found[:, :-1], kinds[:, :-1]
        own = np.maximum(found - DISCOUNT, 0)
        rest = np.minimum(DISCOUNT * different, total)
        p = np.where(total[2] > 0, (own[2] + np.maximum(rest[2], 0.5) * p) / np.maximum(total[2] + 0.5, 1), p)
        # Both classes back off with one weight, that of the class which knows less, so what is new to both costs both alike.
        weight = np.max((rest[:2] + TRUST) / (total[:2] + TRUST), axis=0)
        share = found[:2] / np.maximum(total[:2], 1)
        logs = np.log((1 - weight) * share + weight * p)
        difference = np.where(depth > 0, logs[1] - logs[0], 0)  # the blank before a word is given
        ends = np.cumsum(np.fromiter((len(w) + 2 for w in words), np.int64, len(words)))
        sums = np.concatenate([[0.0], np.cumsum(difference)])
        return np.diff(sums[np.concatenate([[0], ends])])


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


class _Scorer:
    """Per text: the difference of the log-likelihoods over the number of words, and the same for telling words alone.

    Words are scored once and kept.
    """

    def __init__(self, model: ToxicityModel, most: int = 1 << 20):
        self.model, self.most = model, most
        self.keys, self.difference = np.zeros(0, np.uint64), np.zeros(0)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = Words(*_bytes_of(texts))
        unique, index, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        place, known = _find(self.keys, unique)
        if len(self.keys) + int((~known).sum()) > self.most:
            self.keys, self.difference = np.zeros(0, np.uint64), np.zeros(0)
            place, known = _find(self.keys, unique)
        if (~known).any():
            fresh = [words.word(i) for i in index[~known]]
            parts = [_parts(w) for w in fresh]
            owner = np.repeat(np.arange(len(parts)), [len(w) for w in parts])
            found = np.bincount(owner, weights=self.model.word_differences([p for w in parts for p in w]), minlength=len(parts))
            keys = np.concatenate([self.keys, unique[~known]])
            by = np.argsort(keys)
            self.keys, self.difference = keys[by], np.concatenate([self.difference, found])[by]
            place, known = _find(self.keys, unique)
        each = self.difference[place][inverse] if len(unique) else np.zeros(0)
        size = np.maximum(words.per_text, 1)
        whole = np.bincount(words.text_of, weights=each, minlength=len(texts)) / size
        telling = np.bincount(words.text_of, weights=np.where(each > TELLING, each, 0), minlength=len(texts)) / size
        return whole, telling


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        toxic = np.asarray(part.column("toxic")).astype(np.int64)
        words = Words(*_bytes_of(strings(part.column("text"))))
        unique, index, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        if not len(unique):
            continue
        weight = np.stack([np.bincount(inverse, weights=toxic[words.text_of] == side, minlength=len(unique)) for side in (0, 1)])
        parts_of = [_parts(words.word(i)) for i in index]
        spelled = [p for w in parts_of for p in w]
        data, depth = _spelled(spelled)
        word_of = np.repeat(np.arange(len(parts_of)), [len(w) for w in parts_of])
        owner = np.repeat(word_of, [len(w) + 2 for w in spelled])
        parents = np.zeros(len(data), np.uint64)
        begun = _beginnings(data, depth)
        parents[1:] = begun[:-1]
        for k in range(ORDER + 1):
            there = np.flatnonzero(depth >= k - 1) if k else np.arange(len(data))
            grams, first, which = np.unique((_grams(data, k) if k else begun)[there], return_index=True, return_inverse=True)
            n = [np.bincount(which, weights=weight[side][owner[there]], minlength=len(grams)).astype(np.int64) for side in (0, 1)]
            columns = [np.full(len(grams), k, np.int32), grams.view(np.int64), parents[there][first].view(np.int64), *n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "gram", "parent", "n0", "n1"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_texts: int = 12_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    """Models and curve from texts with labels 0 or 1; rows with a NULL id, label or text do not count.

    ``most_texts`` bounds, in expectation, the sample of labels: at most a third of it toxic, the rest ordinary,
    chosen by a hash of the id. Only the texts of these are read further. Beginnings of words that occur once are
    left out.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = {1: most_texts // 3, 0: most_texts - most_texts // 3}
    draw = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 20))
    part = F.when(F.col("toxic") == 1, min(1.0, bounds[1] / max(1, sizes.get(1, 0)))).otherwise(min(1.0, bounds[0] / max(1, sizes.get(0, 0))))
    drawn = F.broadcast(known.filter(draw < part * (1 << 20)))  # most_texts rows of an id and a number
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    sample = texts.join(drawn, "id").withColumn("calibrates", F.pmod(F.xxhash64(F.lit(23), "id"), F.lit(CALIBRATION)) == 0)
    counted = sample.filter("not calibrates").select("text", "toxic").mapInArrow(_count, "k int, gram long, parent long, n0 long, n1 long")
    grams = counted.groupBy("k", "gram").agg(F.first("parent").alias("parent"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = grams.filter((F.col("k") > 0) | (F.col("n0") + F.col("n1") > 1)).toArrow()
    get = lambda c: found.column(c).to_numpy()
    model = ToxicityModel.of_counts(get("k"), get("gram").view(np.uint64), get("parent").view(np.uint64), np.stack([get("n0"), get("n1")]))
    held = score_differences(sample.filter("calibrates"), model, "toxic", "text").toArrow()
    features = np.stack([held.column(c).to_numpy() for c in ("whole", "telling")], axis=1)
    model.weights = _logistic(features, held.column("toxic").to_numpy(), sizes, bounds)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, sizes: dict, bounds: dict) -> tuple[float, ...]:
    """Slopes and offset by Newton steps, with a small penalty; rows weigh as their class does among all labelled ones.

    A text without any evidence is taken as ordinary: one such row has the weight of a tenth of all ordinary ones.
    """
    if len(set(y.tolist())) < 2:
        return 0.0, 0.0, 0.0 if not len(y) else (5.0 if y[0] else -5.0)
    weight = np.where(y == 1, max(1.0, sizes[1] / bounds[1]), max(1.0, sizes[0] / bounds[0]))
    scale = np.maximum(np.abs(x).mean(axis=0), 1e-9)
    x, y, weight = np.vstack([x, np.zeros(x.shape[1])]), np.append(y, 0), np.append(weight, weight[y == 0].sum() / 10)
    features = np.concatenate([x / scale, np.ones((len(x), 1))], axis=1)
    w = np.zeros(features.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (weight * (y - p)) - 1e-2 * w
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(len(w))
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in (*(w[:-1] / scale), w[-1]))


def score_differences(docs: DataFrame, model: ToxicityModel, id_column: str, text_column: str) -> DataFrame:
    """Id column, ``whole`` and ``telling``: length-normalised toxic minus ordinary log-likelihoods.

    ``text_column`` may be a field of a struct that is the id, as ``id.field``: texts then go to the workers once.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on

    field = text_column.removeprefix(f"{id_column}.") if text_column.startswith(f"{id_column}.") else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        if field is not None:
            batches = (pa.RecordBatch.from_arrays([b.column("id"), pc.struct_field(b.column("id"), [field])], names=["id", "text"]) for b in batches)
        for part in text_slices(batches, "text", _SCORED_BYTES):
            whole, telling = scorer(strings(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(whole), pa.array(telling)], names=[id_column, "whole", "telling"])

    rows = docs.select(F.col(id_column).alias("id"), *([] if field else [F.col(text_column).alias("text")]))
    return rows.mapInArrow(work, f"`{id_column}` {kind}, whole double, telling double")


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 from 0.5) of every row.

    The whole text is read. A NULL or empty text differs by 0 and so has the score of a text without evidence. Ids may
    be NULL or repeat; other columns are not read, whatever their names.
    """
    whole, telling, offset = model.weights
    value = 1 / (1 + F.exp(-(F.col("whole") * whole + F.col("telling") * telling + offset)))
    scored = score_differences(docs, model, id_column, text_column).select(id_column, value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
