"""Language-model scoring with a weighted backoff automaton.

Byte n-grams of the training texts are counted over the whole corpus. Every context that occurs is a state. Its
arcs carry smoothed probabilities (interpolated Witten-Bell), and a failure arc with the backoff weight leads
to the context without its first byte. A text is spelled from left to right, one end sign after each word and one
after the text; its score adds up the log-probabilities on its path.

The automaton grows with the corpus and stays in a table; no context is left out. A block of texts needs only the states that its
own texts pass: it asks for its different n-grams once, joins follow the failure arcs for each of them and send back the
weight of the arc with those of the failures on the way. From these the block builds its own automaton, in which every
state has its arcs at hand, and traverses it from left to right. Words' counts in the corpus come the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keystrata.llm.batches import text_slices, utf8
from keystrata.llm.words import _SPACE, Words, mixed
from keystrata.session import small_batches, written

ORDER = 6  # bytes, the predicted one included
BLOCK_BYTES = 16 << 20
WORD_END, TEXT_END = 0x20, 0x00
_START = np.uint64(sum(WORD_END << 8 * k for k in range(ORDER)))  # what a text starts behind
_COUNTED_BYTES = 1 << 20  # texts whose n-grams are counted at once: up to some hundred bytes of numbers are held for each of these
_SENT = 1 << 17  # n-grams sent at once: 2 MB
_SEGMENT = 2048
_ADD = 0.1


def spelled(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, and the offsets of the texts: word, word end, ..., text end.

    A byte 0 in a word is spelled as byte 1, so that 0 stands for the end of a text alone.
    """
    sizes = words.ends - words.starts
    texts = len(words.per_text)
    per_text = np.bincount(words.text_of, weights=sizes + 1, minlength=texts).astype(np.int64) + 1
    offsets = np.concatenate([[0], np.cumsum(per_text)])
    last = np.cumsum(sizes + 1) - 1 + words.text_of  # one text end for each text before
    inner = np.ones(offsets[-1], bool)
    inner[last] = inner[offsets[1:] - 1] = False
    out = np.full(offsets[-1], WORD_END, np.uint8)
    out[offsets[1:] - 1] = TEXT_END
    out[inner] = np.maximum(words.data[~_SPACE[words.data]], 1)
    return out, offsets


def _ngrams(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram of the full order up to each symbol, packed. Each text starts behind a word end."""
    shifted = symbols.astype(np.uint64)
    packed = shifted.copy()
    for k in range(1, min(ORDER, len(symbols))):
        shifted <<= np.uint64(8)
        packed[k:] |= shifted[:-k]
    if len(symbols) < ORDER:
        packed &= np.uint64((1 << 8 * ORDER) - 1)
    for place in range(min(ORDER - 1, len(symbols))):
        at = offsets[:-1] + place
        at = at[at < offsets[1:]]
        own = np.uint64((1 << 8 * (place + 1)) - 1)
        packed[at] = packed[at] & own | _START & ~own
    return packed


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of all texts and how often training texts have them."""
    for part in text_slices(batches, "text", _COUNTED_BYTES):
        symbols, offsets = spelled(Words(*utf8(part.column("text"))))
        packed, trained = _ngrams(symbols, offsets), np.repeat(np.asarray(part.column("trains")), np.diff(offsets))
        for whose, times in ((trained, 1), (~trained, 0)):
            mine = packed[whose]
            mine.sort()
            first = np.flatnonzero(np.concatenate([np.ones(min(len(mine), 1), bool), mine[1:] != mine[:-1]]))
            n = np.diff(first, append=len(mine)) * times
            for a in range(0, len(first), _SENT):  # the executor holds what is sent at once outside its heap
                grams = mine[first[a : a + _SENT]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n[a : a + _SENT])], names=["gram", "n"])


@dataclass
class Automaton:
    """The whole automaton of a small corpus in memory, its failure arcs apart: blocks' automata are tested against it.

    ``contexts``: bytes of each state, shortest first, the empty one at 0. ``arcs``: per state, symbol to count."""

    contexts: list[bytes]
    follow: np.ndarray  # (states, symbols) next state
    weight: np.ndarray  # (states, symbols) log10 probability
    symbol_of: np.ndarray  # column of each byte

    @classmethod
    def of_counts(cls, arcs: dict[bytes, dict[int, int]]) -> Automaton:
        """From counts of symbols after contexts; the contexts are closed under taking away their first byte."""
        contexts = sorted(set(arcs) | {b""}, key=lambda c: (len(c), c))
        number = {c: i for i, c in enumerate(contexts)}
        seen = sorted({x for following in arcs.values() for x in following} | {WORD_END, TEXT_END})
        column = np.full(256, len(seen), np.int32)  # bytes that never occurred share the last column
        column[seen] = np.arange(len(seen))
        probability = np.empty((len(contexts), len(seen) + 1))
        follow = np.zeros((len(contexts), len(seen) + 1), np.int32)
        for i, context in enumerate(contexts):
            following = arcs.get(context, {})
            failure = number[context[1:]] if context else None
            total, kinds = sum(following.values()), len(following)
            lower = probability[failure] if context else np.full(len(seen) + 1, 1 / 256)
            # The failure arc's weight is the share of all that Witten-Bell leaves to the shorter context.
            probability[i] = lower * (kinds / (total + kinds) if total else 1.0)
            if context:
                follow[i] = follow[failure]
            for x, n in following.items():
                probability[i, column[x]] += n / (total + kinds)
            for x in seen:
                longer = context + bytes([x])
                if longer in number:
                    follow[i, column[x]] = number[longer]
        return cls(contexts, follow, np.log10(probability).astype(np.float32), column)

    @property
    def start(self) -> int:
        """The state behind word ends, in which every text starts."""
        state = 0
        for _ in range(ORDER - 1):
            state = int(self.follow[state, self.symbol_of[WORD_END]])
        return state

    def score(self, symbols: np.ndarray, offsets: np.ndarray, start: int) -> np.ndarray:
        """log10 probability of each text.

        Texts are cut into segments that are traversed side by side. The state after ORDER - 1 symbols does not depend
        on the state before them, so a later segment is led in by that many symbols without adding them up.
        """
        width = self.follow.shape[1]
        follow, weight = self.follow.ravel(), self.weight.ravel()
        codes = self.symbol_of[symbols]
        sizes = np.diff(offsets)
        number = -(-sizes // _SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), number)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        begin = offsets[owner] + part * _SEGMENT
        length = np.minimum(offsets[owner + 1] - begin, _SEGMENT)
        lead = np.where(part > 0, ORDER - 1, 0)
        by = np.argsort(-length, kind="stable")
        owner, begin, length, lead = owner[by], begin[by], length[by], lead[by]
        state = np.where(lead > 0, 0, start).astype(np.int64)
        for k in range(ORDER - 1):
            led = np.flatnonzero(lead > 0)
            state[led] = follow[state[led] * width + codes[begin[led] - (ORDER - 1) + k]]
        total = np.zeros(len(owner))
        live = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")  # segments longer than t
        for t, n in enumerate(live.tolist()):
            arc = state[:n] * width + codes[begin[:n] + t]
            total[:n] += weight[arc]
            state[:n] = follow[arc]
        return np.bincount(owner, weights=total, minlength=len(sizes))


def weights(texts: DataFrame) -> DataFrame:
    """Each n-gram of the texts and its log10 probability; rows of ``texts`` are ``text`` and ``trains``.

    Counts are gathered over all training texts and no context is left out, however rare.
    """
    grams = texts.select("text", "trains").mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = written(grams, "lm-ngrams")
    lower = None
    for k in range(ORDER):  # a context of k bytes and the symbol behind it
        last = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        arcs = grams.groupBy(last.alias("gram")).agg(F.sum("n").alias("n"))
        context = Window.partitionBy(F.shiftright("gram", 8))  # at most 256 arcs
        arcs = arcs.select("gram", "n", F.sum("n").over(context).alias("whole"), F.count_if(F.col("n") > 0).over(context).alias("kinds"))
        if lower is None:
            arcs = arcs.withColumn("back", F.lit(1 / 256))
        else:
            arcs = arcs.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(lower, "shorter")
        # The failure arc's weight is the share of all that Witten-Bell leaves to the shorter context.
        p = F.when(F.col("whole") > 0, (F.col("n") + F.col("kinds") * F.col("back")) / (F.col("whole") + F.col("kinds"))).otherwise(F.col("back"))
        arcs = arcs.select("gram", p.alias("p"))
        lower = arcs.select(F.col("gram").alias("shorter"), F.col("p").alias("back"))
    return arcs.select("gram", F.log10("p").alias("weight"))


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(grams) % np.uint64(buckets)).astype(np.int64)


def _bucketed(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = _bucket(batch.column("gram").to_numpy().view(np.uint64), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column("gram"), batch.column("weight")], names=["bucket", "gram", "weight"])

    return work


def _steps(parts: list[pa.RecordBatch]) -> np.ndarray:
    """The different n-grams of a block, sorted."""
    found = [np.zeros(0, np.uint64)]
    for part in parts:
        found.append(np.unique(_ngrams(*spelled(Words(*utf8(part.column("text")))))))
    return np.unique(np.concatenate(found))


def _by_bucket(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of sorted n-grams by bucket, and for each bucket its number, first and last place in it."""
    bucket = _bucket(grams, buckets)
    by = np.argsort(bucket, kind="stable")
    there, first = np.unique(bucket[by], return_index=True)
    return by, list(zip(there.tolist(), first.tolist(), [*first[1:].tolist(), len(by)]))


def _asked(buckets: int):
    """The different n-grams of a block, packed by bucket."""

    def work(table: pa.Table) -> pa.Table:
        grams = _steps(list(text_slices(iter(table.combine_chunks().to_batches()), "text")))
        by, ranges = _by_bucket(grams, buckets)
        packed = [grams[by[a:b]].tobytes() for _, a, b in ranges]
        block = np.full(len(ranges), table.column("block")[0].as_py(), np.int64)
        return pa.table({"block": block, "bucket": np.array([k for k, _, _ in ranges], np.int64), "grams": pa.array(packed, pa.binary())})

    return work


def _answered(key, arcs: pa.Table, asked: pa.Table) -> pa.Table:
    """The weights of the n-grams that blocks ask for, packed in their order."""
    grams, weight = arcs.column("gram").to_numpy().view(np.uint64), arcs.column("weight").to_numpy().astype("<f4")
    by = np.argsort(grams)
    grams, weight = grams[by], weight[by]
    packed = [weight[np.searchsorted(grams, np.frombuffer(g.as_buffer(), np.uint64))].tobytes() for g in asked.column("grams")]
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "weights": pa.array(packed, pa.binary())})


class _Block:
    """The texts of a block in slices, and the block's distinct words with their numbers in training texts."""

    def __init__(self, table: pa.Table):
        self.parts = list(text_slices(iter(table.combine_chunks().to_batches()), "text"))
        self.words = [Words(*utf8(part.column("text"))) for part in self.parts]
        unique, counts, self.inverse = [np.zeros(0, np.uint64)], [np.zeros(0)], []
        for part, words in zip(self.parts, self.words):
            trained = np.asarray(part.column("trains"))[words.text_of]
            found, inverse = np.unique(words.hashes, return_inverse=True)
            unique.append(found)
            counts.append(np.bincount(inverse, weights=trained, minlength=len(found)))
            self.inverse.append(inverse)
        self.unique, merged = np.unique(np.concatenate(unique), return_inverse=True)
        self.n = np.bincount(merged, weights=np.concatenate(counts), minlength=len(self.unique)).astype(np.int64)
        # Of each slice, where its distinct words are among the block's.
        self.place = np.split(merged, np.cumsum([len(u) for u in unique[1:]])[:-1]) if self.parts else []


def _words(table: pa.Table) -> pa.Table:
    """The distinct words of a block: hash and how often its training texts have them."""
    block = _Block(table)
    return pa.table({"word": block.unique.view(np.int64), "n": block.n, "block": np.full(len(block.unique), table.column("block")[0].as_py(), np.int64)})


class BlockAutomaton:
    """The states that a block's texts pass, from its different n-grams and the weights of these, both sorted by n-gram.

    A state is a context of ORDER - 1 symbols. Its arcs lie side by side; a set of bits says for which symbols there are
    any, and the number of smaller symbols in it is the place of the arc. The failure arcs are in the weights.
    """

    def __init__(self, grams: np.ndarray, weight: np.ndarray):
        context, symbol = grams >> np.uint64(8), (grams & np.uint64(255)).astype(np.int64)
        self.contexts, first, owner = np.unique(context, return_index=True, return_inverse=True)
        self.weight = np.append(weight.astype(np.float32), np.float32(0))
        bits = np.zeros((len(self.contexts), 4), np.uint64)
        np.bitwise_or.at(bits, (owner, symbol >> 6), np.uint64(1) << (symbol & 63).astype(np.uint64))
        before = np.cumsum(np.bitwise_count(bits), axis=1, dtype=np.int64) - np.bitwise_count(bits)
        self.bits, self.first = bits.ravel(), (first[:, None] + before).ravel().astype(np.int32)
        after = grams & np.uint64((1 << 8 * (ORDER - 1)) - 1)
        self.follow = np.append(self.state(after), 0).astype(np.int32)

    def state(self, contexts: np.ndarray) -> np.ndarray:
        """Number of each context; of one that no text goes on from, any."""
        return np.minimum(np.searchsorted(self.contexts, contexts), max(len(self.contexts) - 1, 0))

    def score(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sum of weights on the path of each text. Texts are cut into segments that are traversed side by side."""
        sizes = np.diff(offsets)
        number = -(-sizes // _SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), number)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        begin = offsets[owner] + part * _SEGMENT
        length = np.minimum(offsets[owner + 1] - begin, _SEGMENT)
        by = np.argsort(-length, kind="stable")
        owner, begin, length, part = owner[by], begin[by], length[by], part[by]
        # A text starts behind word ends, a later segment behind the last symbols of the one before.
        context = np.zeros(len(begin), np.uint64)
        for k in range(ORDER - 1, 0, -1):
            seen = np.where(part > 0, symbols[np.maximum(begin - k, 0)], WORD_END)
            context = context << np.uint64(8) | seen.astype(np.uint64)
        state, total = self.state(context).astype(np.int64), np.zeros(len(owner))
        live = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")  # segments longer than t
        for t, n in enumerate(live.tolist()):
            symbol = symbols[begin[:n] + t]
            cell = state[:n] * 4 + (symbol >> 6)
            below = (np.uint64(1) << (symbol & 63).astype(np.uint64)) - np.uint64(1)
            arc = self.first[cell] + np.bitwise_count(self.bits[cell] & below)
            total[:n] += self.weight[arc]
            state[:n] = self.follow[arc]
        return np.bincount(owner, weights=total, minlength=len(sizes))


def _block_scores(buckets: int):
    def work(key, texts: pa.Table, sent: pa.Table) -> pa.Table:
        counts, answers = sent.filter(pc.is_valid(sent.column("word"))), sent.filter(pc.is_valid(sent.column("weights")))
        corpus = counts.column("c").to_numpy()
        sent_words = counts.column("word").to_numpy().view(np.uint64)
        leads = int(np.count_nonzero(counts.column("leads").to_numpy() & (corpus > 0)))
        block = _Block(texts)
        path = [spelled(words) for words in block.words]
        grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(_ngrams(*p)) for p in path)]))
        by, ranges = _by_bucket(grams, buckets)
        weight = np.empty(len(grams))
        answer = dict(zip(answers.column("bucket").to_pylist(), answers.column("weights")))
        for k, a, b in ranges:
            weight[by[a:b]] = np.frombuffer(answer[k].as_buffer(), "<f4")
        automaton = BlockAutomaton(grams, weight)
        # Words of this block alone were not sent back: their counts here are all there are.
        c = block.n
        at = np.searchsorted(block.unique, sent_words)
        alone = np.ones(len(c), bool)
        alone[at] = False
        own = int(np.count_nonzero(alone & (c > 0)))
        c[at] = corpus
        known, logs = (c > 0).astype(np.float64), np.log10(c + _ADD)
        # All slices are traversed at once.
        shift = np.cumsum([0, *(len(p[0]) for p in path)])
        offsets = np.concatenate([[0], *(p[1][1:] + at for p, at in zip(path, shift))])
        scores = automaton.score(np.concatenate([p[0] for p in path]), offsets)
        out, done = [], 0
        for part, words, inverse, place in zip(block.parts, block.words, block.inverse, block.place):
            m, trains, mine = part.num_rows, np.asarray(part.column("trains")), place[inverse]
            out.append(
                pa.table(
                    {
                        "id": part.column("id"),
                        "trains": part.column("trains"),
                        "n_words": words.per_text,
                        "known_words": np.bincount(words.text_of, weights=known[mine], minlength=m).astype(np.int64),
                        "logs": np.bincount(words.text_of, weights=logs[mine], minlength=m).astype(np.float64),
                        "score": scores[done : done + m],
                        "train_words": np.where(trains, words.per_text, 0),
                        "new_words": np.where((np.arange(m) == 0) & (not out), own + leads, 0),
                    }
                )
            )
            done += m
        return pa.concat_tables(out)

    return work


def placed(rows: DataFrame, blocks: int) -> DataFrame:
    """The rows with a block for each by its written row number, so that rows which repeat whole are spread, too."""
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).drop("row")


def score(docs: DataFrame, trains, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Id, ``trains``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``trains`` is a boolean column; rows where it is true make up the training corpus. Tokens are the words, A-Z
    lower-cased, and one end. ``base_score`` adds log10((c + 0.1) / (N + 0.1 (V + 1))) over tokens by their training
    counts; ``score`` is the log10 probability of the whole text by the automaton, every word spelled out. A NULL text
    counts as empty and has the end only, a NULL ``trains`` as false. Ids may be NULL or repeat; other columns are
    not read, whatever their names. Without training texts all symbols are equally likely. Words are told apart by 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    given = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    given = written(given.withColumn("row", F.monotonically_increasing_id()), "lm-texts")
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // block_bytes))
    # Texts move once: both uses below share this exchange.
    dealt = placed(given, blocks).repartition(blocks, "block")
    words = dealt.groupBy("block").applyInArrow(_words, "word long, n long, block long")
    by_word = Window.partitionBy("word")
    counts = words.select(
        "block", "word", F.sum("n").over(by_word).alias("c"), F.count(F.lit(1)).over(by_word).alias("in_blocks"), F.row_number().over(by_word.orderBy("block")).alias("turn")
    )
    counts = counts.filter("in_blocks > 1").select("block", "word", "c", (F.col("turn") == 1).alias("leads"))
    buckets = blocks
    arcs = written(weights(given), "lm-arcs").mapInArrow(_bucketed(buckets), "bucket long, gram long, weight double")
    asked = dealt.groupBy("block").applyInArrow(_asked(buckets), "block long, bucket long, grams binary")
    answered = arcs.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answered, "block long, bucket long, weights binary")
    sent = counts.unionByName(answered, allowMissingColumns=True)
    schema = f"id {kind}, trains boolean, n_words long, known_words long, logs double, score double, train_words long, new_words long"
    scored = written(dealt.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_block_scores(buckets), schema), "lm-scores")
    ends, n_words, kinds = scored.agg(F.count_if("trains"), F.coalesce(F.sum("train_words"), F.lit(0)), F.coalesce(F.sum("new_words"), F.lit(0))).first()
    n, v = n_words + ends, kinds + (ends > 0)
    bottom = math.log10(n + _ADD * (v + 1))
    return scored.select(
        F.col("id").alias(id_column),
        "trains",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known_words") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + math.log10(ends + _ADD) - (F.col("n_words") + 1) * bottom).alias("base_score"),
        "score",
    )
