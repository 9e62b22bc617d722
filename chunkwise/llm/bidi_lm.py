"""Masked pseudo-likelihood of documents (operator 2).

A small network predicts every word from the two words before and the two after it, and a
document's score is the sum of these conditional log-probabilities.  All words of the corpus
are counted.  The network's output is a two-level softmax (the class, then the place in it)
over as many places as the square root of the number of distinct words: three quarters are
the most frequent words, the others are slots that the remaining words share by hash.  A
word of a slot has the slot's probability times its share of the slot's words in the full
count table, so the probabilities of all words of the corpus sum to one.

The count table is never gathered: the counts of at most KNOWN_COUNTS of the most frequent
words are broadcast, and documents are encoded in blocks, each of which asks for the counts
of its other distinct words by a join and is scored together with the answer.

Training is in numpy inside the tasks and covers every document once: in each round the
tasks start from the same weights, learn from a slice of their documents, and the weights
are averaged by the number of words seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCKS, array_blocks, id_text, slices, stored, sum_arrays, word_hashes

#: Least number of places of the softmax; beyond it, the square root of the distinct words.
LEAST_PLACES = 1024
WINDOW = (-2, -1, 1, 2)
DIM = 16
ROUNDS = 3
RATE = 0.15
BATCH_WORDS = 1 << 14
#: Text bytes of an encoded block (a longer document is a block of its own).
BLOCK_BYTES = 4 << 20
#: Words whose counts are broadcast (16 bytes each); the others' come by a join.
KNOWN_COUNTS = 1 << 18
#: Distinct words that a counting task holds before it passes their counts on.
HELD_WORDS = 2_000_000


def places(distinct: int) -> int:
    """Places of the softmax: the power of two nearest to the root of ``distinct``."""
    return max(LEAST_PLACES, 1 << round(np.log2(max(distinct, 1)) / 2))


def _shapes(size: int) -> list[tuple[int, ...]]:
    classes = 1 << (size.bit_length() - 1) // 2
    members = size // classes
    return [(len(WINDOW), size + 1, DIM), (DIM,), (DIM, classes), (classes,),
            (classes, DIM, members), (classes, members)]


def n_weights(size: int) -> int:
    return sum(int(np.prod(s)) for s in _shapes(size))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word hash, n) over all documents; tasks combine before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], ["word", "n"])

        fresh_words, fresh_n = [], 0
        for batch in batches:
            for a, b in slices(batch.column(1)):
                words, _ = word_hashes(batch.column(1).slice(a, b - a))
                fresh_words.append(words.view(np.int64))
                fresh_n += len(words)
                if fresh_n > HELD_WORDS:
                    held, counts = _merge(held, counts, fresh_words)
                    fresh_words, fresh_n = [], 0
                    if len(held) > HELD_WORDS:
                        yield out()
                        held, counts = held[:0], counts[:0]
        held, counts = _merge(held, counts, fresh_words)
        yield out()

    return (docs.mapInArrow(run, "word bigint, n bigint").groupBy("word")
            .agg(F.sum("n").alias("n")))


def _merge(held, counts, more):
    words, n = np.unique(np.concatenate(more) if more else held[:0], return_counts=True)
    words, back = np.unique(np.concatenate([held, words]), return_inverse=True)
    return words, np.bincount(back, np.concatenate([counts, n]), len(words)).astype(np.int64)


class Vocabulary:
    """Word hash -> place: frequent words by rank, the others by hash.  ``slot_words`` are
    the occurrences of all words, the frequent ones included, by ``hash & (slots - 1)``."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, slot_words: np.ndarray,
                 known: np.ndarray | None = None, known_n: np.ndarray | None = None):
        self.slots = len(slot_words)
        self.size = 4 * self.slots
        self.frequent = self.size - self.slots
        #: occurrences of each slot's remaining words
        rest = slot_words - np.bincount(words & (self.slots - 1), counts, self.slots)
        self.share = np.full(self.size, 0.1)
        self.share[:len(counts)] = counts
        self.share[self.frequent:] += rest
        self.share /= self.share.sum()
        self.log_rest = np.log(np.maximum(rest, 1))
        known, known_n = (words[:0], counts[:0]) if known is None else (known, known_n)
        other = ~np.isin(known, words)
        known, slot = known[other], known[other] & (self.slots - 1)
        by = np.argsort(np.concatenate([words, known]))
        self.words = np.concatenate([words, known])[by]
        self.ids = np.concatenate([np.arange(len(words)), self.frequent + slot])[by]
        self.logs = np.concatenate([np.zeros(len(words)),
                                    np.log(known_n[other]) - self.log_rest[slot]])[by]

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        """From (word, n).  To the driver come rows for three quarters of the places, a sum
        for each slot and the counts of at most KNOWN_COUNTS words."""
        size = places(counts.count())
        top = counts.orderBy(F.desc("n"), "word").limit(size - size // 4).toArrow()
        sums = (counts.groupBy(F.col("word").bitwiseAND(F.lit(size // 4 - 1)).alias("slot"))
                .agg(F.sum("n").alias("n"))).toArrow()
        slot_words = np.zeros(size // 4)
        slot_words[sums["slot"].to_numpy()] = sums["n"].to_numpy()
        # eight levels of frequency for each doubling: the levels that fit as a whole
        level = F.floor(8 * F.log2("n")).cast("int")
        least, room = 1 << 30, KNOWN_COUNTS
        for at, n in sorted(counts.groupBy(level).count().collect(), reverse=True):
            room -= n
            if room < 0:
                break
            least = at
        known = counts.filter(level >= least).toArrow()
        return cls(top["word"].to_numpy(), top["n"].to_numpy(), slot_words,
                   known["word"].to_numpy(), known["n"].to_numpy())

    def encode(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, log P(word | its place), whether the word's count is known); where it is
        not, the logarithm of the count is still to be added."""
        words = hashes.view(np.int64)
        slot = words & (self.slots - 1)
        out, logs = (self.frequent + slot).astype(np.uint32), -self.log_rest[slot]
        if not len(self.words):
            return out, logs, np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = self.words[at] == words
        out[known], logs[known] = self.ids[at[known]], self.logs[at[known]]
        return out, logs, known


class WindowNetwork:
    def __init__(self, parts: list[np.ndarray]):
        (self.embed, self.bias, self.to_class, self.class_bias, self.to_word,
         self.word_bias) = self.parts = parts
        self.classes, self.members = self.word_bias.shape
        self.pad = self.classes * self.members

    @classmethod
    def fresh(cls, share: np.ndarray, seed: int = 5) -> WindowNetwork:
        rng = np.random.default_rng(seed)
        parts = [rng.normal(0, 0.1, s).astype(np.float32) for s in _shapes(len(share))]
        parts[0][:, len(share)] = 0
        by_class = share.reshape(parts[5].shape)
        parts[3][:] = np.log(by_class.sum(1))
        parts[5][:] = np.log(by_class / by_class.sum(1, keepdims=True))
        return cls(parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parts]).astype(np.float64)

    @classmethod
    def of(cls, flat: np.ndarray, size: int) -> WindowNetwork:
        shapes = _shapes(size)
        cuts = np.split(flat.astype(np.float32), np.cumsum([np.prod(s) for s in shapes])[:-1])
        return cls([c.reshape(s) for c, s in zip(cuts, shapes)])

    def _hidden(self, seq: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = self.bias + self.embed[0][seq[at + WINDOW[0]]]
        for k in range(1, len(WINDOW)):
            total += self.embed[k][seq[at + WINDOW[k]]]
        return np.tanh(total, out=total)

    @staticmethod
    def _softmax(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, mine,
                 learn) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities, log-probability of the places ``mine``); unless it learns, the
        first are left unnormalised.  |h| < 1 bounds the sums, so the usual shift by each
        row's maximum is needed only where the weights are large."""
        z = h @ weights
        z += bias
        if np.abs(weights).sum(0).max() + np.abs(bias).max() > 60:
            z -= z.max(1, keepdims=True)
        out = z[mine]
        p = np.exp(z, out=z)
        total = p.sum(1)
        out -= np.log(total)
        if learn:
            p /= total[:, None]
        return p, out

    def log_probs(self, seq: np.ndarray, at: np.ndarray, learn=None) -> np.ndarray:
        """log P(word | both sides) at the positions ``at`` of a padded sequence; ``learn``
        is called with the gradients of their mean."""
        h = self._hidden(seq, at)
        word = seq[at]
        of, member = word // self.members, word % self.members
        row = np.arange(len(at))
        p, out = self._softmax(h, self.to_class, self.class_bias, (row, of), learn)
        # small integers are sorted by radix
        order = np.argsort(of.astype(np.uint16 if self.classes <= 1 << 16 else of.dtype), kind="stable")
        cuts = np.searchsorted(of[order], np.arange(self.classes + 1))
        if learn:
            grads = [np.zeros_like(x) for x in self.parts]
            p[row, of] -= 1
            p /= len(at)
            grads[2], grads[3] = h.T @ p, p.sum(0)
            back = p @ self.to_class.T
        for c in np.flatnonzero(np.diff(cuts)):
            rows = order[cuts[c]:cuts[c + 1]]
            hc = h[rows]
            mine = np.arange(len(rows)), member[rows]
            q, logq = self._softmax(hc, self.to_word[c], self.word_bias[c], mine, learn)
            out[rows] += logq
            if learn:
                q[mine] -= 1
                q /= len(at)
                grads[4][c], grads[5][c] = hc.T @ q, q.sum(0)
                back[rows] += q @ self.to_word[c].T
        if learn:
            back *= 1 - h * h
            grads[1] = back.sum(0)
            by_dim = np.ascontiguousarray(back.T, np.float64)
            for k, offset in enumerate(WINDOW):
                side = seq[at + offset].astype(np.intp)
                for d in range(DIM):
                    grads[0][k][:, d] = np.bincount(side, by_dim[d], self.pad + 1)
            grads[0][:, self.pad] = 0
            learn(grads)
        return out

    def learner(self):
        squares = [np.full(p.shape, 1e-6, np.float32) for p in self.parts]

        def step(grads):
            for p, g, s in zip(self.parts, grads, squares):
                s += g * g
                p -= RATE * g / np.sqrt(s)
        return step


def padded(docs: list[np.ndarray], pad: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sequence, positions of its words, document of each), about BATCH_WORDS words at a
    time; documents are kept whole, with two pads on either side."""
    gap = np.full(2, pad, np.int32)
    k = 0
    while k < len(docs):
        end, words = k, 0
        while end < len(docs) and (end == k or words + len(docs[end]) <= BATCH_WORDS):
            words += len(docs[end])
            end += 1
        seq = np.concatenate([gap, *(x for d in docs[k:end] for x in (d.astype(np.int32), gap))])
        doc = np.repeat(np.arange(k, end), [len(d) for d in docs[k:end]])
        yield seq, np.flatnonzero(seq != pad), doc
        k = end


def _pack(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), "zstd", asbytes=True)


def _unpack(cell, dtype) -> np.ndarray:
    raw = cell.as_py()
    size = int.from_bytes(raw[:8], "little") * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True), dtype)


def _documents(row: dict) -> list[np.ndarray]:
    """The places of each document's words of an encoded block."""
    return np.split(_unpack(row["words"], np.uint32), np.cumsum(row["n_words"].values.to_numpy())[:-1])


def _rows(batch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i] for name in batch.schema.names}


def encode_blocks(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Blocks of about BLOCK_BYTES of text: of its documents the ids, word counts, sums of
    log P(word | its place) and numbers of words whose count is not known; the places of all
    words; and of the words without a known count the distinct hashes (``keys``) and, word by
    word, the positions there (``rare``)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["block", "doc_id", "n_words", "shares", "n_rare", "words", "rare", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, []

        def out():
            ids, counts, shares, n_rare, spots, rare = zip(*held)
            keys, at = np.unique(np.concatenate(rare), return_inverse=True)
            lists = [pa.array([x], pa.list_(t)) for x, t in (
                (pa.concat_arrays(ids), pa.int64()), (np.concatenate(counts), pa.int64()),
                (np.concatenate(shares), pa.float64()), (np.concatenate(n_rare), pa.int64()))]
            blobs = [pa.array([_pack(x)], pa.binary())
                     for x in (np.concatenate(spots), at.astype(np.uint32), keys)]
            return pa.RecordBatch.from_arrays([pa.array([block]), *lists, *blobs], names)

        size = 0
        for batch in batches:
            texts = batch.column(1)
            for a, b in slices(texts):
                part = texts.slice(a, b - a)
                hashes, counts = word_hashes(part)
                spots, logs, known = shared.value.encode(hashes)
                doc = np.repeat(np.arange(b - a), counts)
                held.append((batch.column(0).slice(a, b - a), counts, np.bincount(doc, logs, b - a),
                             np.bincount(doc[~known], minlength=b - a), spots,
                             hashes.view(np.int64)[~known]))
                size += part.nbytes
                if size >= BLOCK_BYTES:
                    yield out()
                    block, size = block + 1, 0
                    held.clear()
        if held:
            yield out()

    return docs.mapInArrow(run, "block bigint, doc_id array<bigint>, n_words array<bigint>, "
                                "shares array<double>, n_rare array<bigint>, "
                                "words binary, rare binary, keys binary")


def rare_counts(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, pos, n): the counts above one of each block's ``keys``, by position.  A row a
    distinct word of a block is joined, never one an occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                keys = _unpack(row["keys"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), row["block"].as_py())),
                     pa.array(np.arange(len(keys), dtype=np.int32)), pa.array(keys)],
                    ["block", "pos", "word"])

    asked = blocks.select("block", "keys").mapInArrow(run, "block bigint, pos int, word bigint")
    return asked.join(counts.filter("n > 1"), "word").select("block", "pos", "n")


def train(blocks: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> WindowNetwork:
    """One pass over all documents: in round r, every ``rounds``-th of each block from the
    r-th on."""
    spark, network, size = blocks.sparkSession, WindowNetwork.fresh(share), len(share)
    for r in range(rounds):
        start = spark.sparkContext.broadcast(network.flat())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, seen = WindowNetwork.of(start.value, size), 0
            step = net.learner()
            for batch in batches:
                for row in _rows(batch):
                    for seq, at, _ in padded(_documents(row)[r::rounds], net.pad):
                        if len(at):
                            net.log_probs(seq, at, step)
                            seen += len(at)
            if seen:
                yield array_blocks(np.append(net.flat() * seen, seen))

        total = sum_arrays(blocks.select("n_words", "words").mapInArrow(run, BLOCKS), n_weights(size) + 1)
        if total[-1]:
            network = WindowNetwork.of(total[:-1] / total[-1], size)
        start.unpersist()
    return network


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) of every row.

    ``log_likelihood`` sums log P(word | two words on either side) over the whole text.  A
    null text counts as empty; without words the sum is 0 and the mean null.  Repeated rows
    get equal scores; an empty table gives an empty result; other columns are ignored.
    """
    rows = id_text(docs, id_col, text_col)
    counts = stored(word_counts(rows), "lm-words")
    vocabulary = Vocabulary.of(counts)
    blocks = stored(encode_blocks(rows, vocabulary), "lm-blocks")
    network = train(blocks, vocabulary.share, rounds)
    size = vocabulary.size
    shared = docs.sparkSession.sparkContext.broadcast(network.flat())

    def score(asked: pa.Table, found: pa.Table) -> pa.Table:
        net, row = WindowNetwork.of(shared.value, size), next(_rows(asked.combine_chunks()))
        texts, rare = _documents(row), _unpack(row["rare"], np.uint32)
        sums = row["shares"].values.to_numpy().copy()
        for seq, at, doc in padded(texts, net.pad):
            if len(at):
                sums += np.bincount(doc, net.log_probs(seq, at), len(texts))
        n = np.ones(int(rare.max(initial=0)) + 1)
        n[found["pos"].to_numpy()] = found["n"].to_numpy()
        doc = np.repeat(np.arange(len(texts)), row["n_rare"].values.to_numpy())
        sums += np.bincount(doc, np.log(n[rare]), len(texts))
        return pa.table({"doc_id": row["doc_id"].values, "n_words": row["n_words"].values,
                         "log_likelihood": sums})

    return (blocks.drop("keys").groupBy("block")
            .cogroup(rare_counts(blocks, counts).groupBy("block"))
            .applyInArrow(score, "doc_id bigint, n_words bigint, log_likelihood double")
            .withColumn("mean_log_likelihood",
                        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))))
