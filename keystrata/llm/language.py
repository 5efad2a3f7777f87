"""Language identification by a convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter's largest response is kept
and a softmax layer names the language. For use, embedding and filters are multiplied out into tables of byte pairs, so
that a filter costs one or two look-ups a byte. All windows of a text are read; their log-probabilities are averaged
by the number of bytes in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystrata.llm.batches import text_slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
_TOGETHER = 1024  # windows that are worked on at once

_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 0x20
_FOLD[[*range(0x09, 0x0E)]] = 0x20
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x61:0x7B] = _ASCII_LETTER[0x41:0x5B] = True


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes cut into windows (padded with 0), the text of each window and how many bytes it has."""
    sizes = np.diff(offsets)
    number = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), number)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    start = offsets[owner] + part * WINDOW
    length = np.minimum(offsets[owner + 1] - start, WINDOW)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    return np.where(inside, _FOLD[data[np.minimum(at, max(len(data) - 1, 0))]], 0) if len(data) else np.zeros((0, WINDOW), np.int64), owner, length


@dataclass
class ByteCNN:
    languages: list[str]
    parameters: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        p = self.parameters
        p["embedding"] = draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        for w in WIDTHS:
            p[f"filter{w}"] = draw.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
        p["bias"] = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        p["out"] = draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(self.languages))).astype(np.float32)
        p["out_bias"] = np.zeros(len(self.languages), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.parameters, len(x)
        embedded = p["embedding"][x]
        views, pooled, places = {}, [], {}
        for w in WIDTHS:
            views[w] = np.concatenate([embedded[:, k : WINDOW - w + 1 + k] for k in range(w)], axis=2)
            response = views[w] @ p[f"filter{w}"]
            places[w] = response.argmax(axis=1)
            pooled.append(np.take_along_axis(response, places[w][:, None], 1)[:, 0])
        hidden = np.concatenate(pooled, axis=1) + p["bias"]
        active = np.maximum(hidden, 0)
        logits = active @ p["out"] + p["out_bias"]
        probability = np.exp(logits - logits.max(axis=1, keepdims=True))
        probability /= probability.sum(axis=1, keepdims=True)
        delta = probability
        delta[np.arange(n), y] -= 1
        delta /= n
        g = {"out": active.T @ delta, "out_bias": delta.sum(axis=0)}
        back = (delta @ p["out"].T) * (hidden > 0)
        g["bias"], g["embedding"] = back.sum(axis=0), np.zeros_like(p["embedding"])
        for i, w in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            best = np.take_along_axis(views[w], places[w][:, :, None], 1)  # (n, filters, w * embedding)
            g[f"filter{w}"] = np.einsum("nf,nfe->ef", part, best)
            spread = (part[:, :, None] * p[f"filter{w}"].T[None]).reshape(n, FILTERS, w, EMBEDDING)
            letters = x[np.arange(n)[:, None, None], places[w][:, :, None] + np.arange(w)]
            np.add.at(g["embedding"], letters.ravel(), spread.reshape(-1, EMBEDDING))
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 0) -> None:
        """Adam on random batches of windows."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        second = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        for t in range(1, steps + 1):
            chosen = draw.integers(0, len(x), batch)
            for k, g in self.gradients(x[chosen], y[chosen]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                step = (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
                self.parameters[k] = (self.parameters[k] - rate * (1 - 0.9 * t / steps) * step).astype(np.float32)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Responses of the filters of each width to byte pairs, one after the other, and to a last single byte."""
        out = {}
        for w in WIDTHS:
            single = [self.parameters["embedding"] @ self.parameters[f"filter{w}"][k * EMBEDDING : (k + 1) * EMBEDDING] for k in range(w)]
            pairs = [(single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS) for k in range(0, w - 1, 2)]
            out[w] = pairs + ([single[-1]] if w % 2 else [])
        return out

    def log_probabilities(self, x: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for a in range(0, len(x) if self.languages else 0, _TOGETHER):
            part = x[a : a + _TOGETHER]
            pairs = part[:, :-1] * 256 + part[:, 1:]
            pooled = []
            for w in WIDTHS:
                places = WINDOW - w + 1
                response = np.take(tables[w][0], pairs[:, :places], axis=0)
                for k, one in enumerate(tables[w][1:], 1):
                    response += np.take(one, (pairs if len(one) > 256 else part)[:, 2 * k : 2 * k + places], axis=0)
                pooled.append(response.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.parameters["bias"], 0)
            logits = hidden @ self.parameters["out"] + self.parameters["out_bias"]
            logits -= logits.max(axis=1, keepdims=True)
            out[a : a + _TOGETHER] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out


def fit(
    labelled: DataFrame,
    most_texts: int = 1_500,
    most_windows: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    steps: int = 500,
) -> ByteCNN:
    """A network from texts whose language is known; rows with a NULL text, label or id do not count.

    ``most_texts`` bounds, in expectation, the texts per language that are read, chosen by a hash of the id;
    ``most_windows`` bounds the windows that each gives, spread evenly over it. Without any labelled text the network
    knows no language.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label"))
    rows = rows.filter("text is not null and label is not null and id is not null")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    net = ByteCNN(languages)
    net.start()
    if not languages:
        return net
    part = F.lit(0.0)
    for name, n in sizes.items():
        part = F.when(F.col("label") == name, min(1.0, most_texts / n)).otherwise(part)
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) < part * (1 << 20))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            x, owner, _ = windows_of(*utf8(batch.column("text")))
            number = np.bincount(owner, minlength=batch.num_rows)
            turn = np.arange(len(owner)) - (np.cumsum(number) - number)[owner]
            kept = turn * most_windows // np.maximum(number[owner], 1) != (turn - 1) * most_windows // np.maximum(number[owner], 1)
            labels = batch.column("label").take(pa.array(owner[kept]))
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in x[kept].astype(np.uint8)], pa.binary()), labels], names=["window", "label"])

    found = drawn.select("text", "label").mapInArrow(cut, "window binary, label string").toArrow().combine_chunks()
    order = np.array(sorted(range(found.num_rows), key=found.column("window").to_pylist().__getitem__), np.int64)  # training does not depend on the order of tasks
    x = np.frombuffer(b"".join(found.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW).astype(np.int64)[order]
    y = np.searchsorted(languages, np.array(found.column("label").to_pylist(), object).astype(str))[order]
    if len(x):
        # Languages count alike, however many windows each has.
        by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
        most = max(map(len, by_language))
        even = np.concatenate([np.resize(at, most) for at in by_language if len(at)])
        net.train(x[even], y[even], steps)
    return net


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = np.diff(ascii_letters[offsets]) > 0
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def identify(docs: DataFrame, net: ByteCNN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score`` (the probability of that language) of every row.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text if the network knows no language. Ids
    may be NULL or repeat; other columns are not read, whatever their names.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of parameters for each language

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for part in text_slices(batches, "text"):
            data, offsets = utf8(part.column("text"))
            x, owner, length = windows_of(data, offsets)
            logs = net.log_probabilities(x, tables)
            sums = np.stack([np.bincount(owner, weights=logs[:, k] * length, minlength=part.num_rows) for k in range(len(net.languages))], axis=1) if net.languages else np.zeros((part.num_rows, 0))
            known = _has_letter(data, offsets) & bool(net.languages)
            names, scores = ["und"] * part.num_rows, np.zeros(part.num_rows)
            for i in np.flatnonzero(known):
                mean = sums[i] / max(1, offsets[i + 1] - offsets[i])
                p = np.exp(mean - mean.max())
                best = int(p.argmax())
                names[i], scores[i] = net.languages[best], p[best] / p.sum()
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(scores)], names=[id_column, "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, f"`{id_column}` {kind}, lang_pred string, score double")
