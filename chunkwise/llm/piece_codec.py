"""SentencePiece BPE encoding and decoding in vectorised merge rounds (operator 8).

A text is cut where no piece can reach across, before each run of spaces; every distinct
such word is encoded once per task.  The characters of all new words lie in one flat symbol
array.  A round takes each word's best pair rank (a segmented minimum), merges its leftmost
occurrences that don't overlap in all words at once, and compacts the array; words without
a pair left are taken out.  Ranks whose merge could make a pair of the same or a better rank
(so that the order of occurrences matters) merge one occurrence a round.

Decoding looks up the bytes of all ids of a batch in one gather.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

SPACE = "▁"
#: Distinct words that a task remembers.
REMEMBERED = 200_000
#: Bytes of text encoded and decoded at once: the arrays for it are up to 100 times as large.
SLICE_BYTES = 1 << 18
_NONE = np.int64(1 << 40)

codecs.register_error("piece_bytes", lambda e: ("�", e.start + 1))


def _gather(values: np.ndarray, offs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments ``which`` of a flat array, one after another, and their lengths."""
    lens = offs[which + 1] - offs[which]
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(offs[which] - (ends - lens), lens)
    return values[at], lens


class WordMemory:
    """The ids of words that a task has met, at most about ``most`` of them: when there are
    more, those met least often are forgotten.  ``learn`` gives the ids of new words as
    (words, ids one after another, number of each)."""

    def __init__(self, learn, most: int):
        self.learn, self.most = learn, most
        self.known: dict[str, int] = {}
        self.ids, self.offs = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _shed(self) -> None:
        keep = self.uses > 1
        if keep.sum() > self.most // 2:
            keep &= self.uses > np.partition(self.uses, -self.most // 2)[-self.most // 2]
        at = np.flatnonzero(keep)
        words = list(self.known)
        self.known = {words[i]: k for k, i in enumerate(at.tolist())}
        self.ids, lens = _gather(self.ids, self.offs, at)
        self.offs, self.uses = np.concatenate([[0], np.cumsum(lens)]), self.uses[at] // 2

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of each)."""
        if len(self.known) > self.most:
            self._shed()
        which = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        if len(miss := np.flatnonzero(which < 0)):
            missing = [words[i] for i in miss.tolist()]
            new, ids, lens = self.learn(list(dict.fromkeys(missing)))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.offs = np.concatenate([self.offs, len(self.ids) + np.cumsum(lens)])
            self.ids = np.concatenate([self.ids, ids])
            which[miss] = np.fromiter(map(self.known.__getitem__, missing), np.int64, len(miss))
        uses = np.bincount(which, minlength=len(self.known))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        return _gather(self.ids, self.offs, which)


class PieceCodec:
    """Encoder and decoder for a SentencePiece BPE model file with identity normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix
                or kinds & {kind.USER_DEFINED, kind.UNUSED}):
            raise ValueError("only BPE models with identity normalisation and plain pieces")
        self.dummy_prefix = norm.add_dummy_prefix
        self.size = len(model.pieces)
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self._ranks(ids, [p.score for p in model.pieces])
        # symbols: ids of pieces, then size + code point for other characters
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_symbol[ord(piece)] = i
        self.byte_id = np.full(256, next((i for i, p in enumerate(model.pieces)
                                          if p.type == kind.UNKNOWN), 0), np.int64)
        self.byte_fallback = kind.BYTE in kinds
        text = []
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
                text.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kind.CONTROL:
                text.append(b"")
            elif p.type == kind.UNKNOWN:
                text.append((model.trainer_spec.unk_surface or " ⁇ ").encode())
            else:
                text.append(p.piece.replace(SPACE, " ").encode())
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.piece_offs = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.normal = np.array([p.type == kind.NORMAL for p in model.pieces])
        self.control = np.array([p.type == kind.CONTROL for p in model.pieces])
        self.leads = np.array([p.piece.startswith(SPACE) for p in model.pieces]) & self.normal
        # a piece with a space inside would reach across the cuts: then texts stay whole
        inner = any(SPACE in p.lstrip(SPACE) for p in ids)
        self.word = re.compile("(?s:.+)" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.forget()

    def forget(self) -> None:
        self.memory = WordMemory(lambda words: (words, *self._encode_words(words)), REMEMBERED)

    def _ranks(self, ids: dict[str, int], scores: list[float]) -> None:
        """Every pair of symbols that makes a piece, sorted by key, with the piece and its
        rank (equal scores, equal rank; smaller is better)."""
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        key, made, rank, careful = [], [], [], set()
        for piece, i in ids.items():
            r = order[scores[i]]
            for cut in range(1, len(piece)):
                parts = [p for p in (piece[:cut], piece[cut:]) if p in ids or len(p) == 1]
                if len(parts) == 2:
                    pair = [ids.get(p) or self.size + ord(p) for p in parts]
                    key.append(pair[0] << 32 | pair[1])
                    made.append(i)
                    rank.append(r)
                    merged = [order[scores[ids[p]]] for p in parts if len(p) > 1]
                    careful.update(m for m in merged if m >= r)
        by = np.argsort(np.array(key, np.int64))
        self.pair_key = np.append(np.array(key, np.int64)[by], np.int64(-1))
        self.pair_made = np.append(np.array(made, np.int64)[by], 0)
        self.pair_rank = np.append(np.array(rank, np.int64)[by], _NONE)
        self.careful = np.zeros(len(order) + 1, bool)
        self.careful[list(careful)] = True

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.searchsorted(self.pair_key[:-1], key)
        at[self.pair_key[at] != key] = len(self.pair_key) - 1
        return self.pair_rank[at], self.pair_made[at]

    def _merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all words in order, number of each)."""
        sym = self.char_symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, made = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
        near = np.flatnonzero(word[:-1] == word[1:])
        rank[near], made[near] = self._pairs(sym[near], sym[near + 1])
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            lens = np.diff(np.append(starts, len(sym)))
            if (best == _NONE).any():
                over = np.repeat(best == _NONE, lens)
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank, made = sym[~over], word[~over], rank[~over], made[~over]
                lens, best = lens[best != _NONE], best[best != _NONE]
                if not len(sym):
                    break
            best = np.repeat(best, lens)
            at = np.flatnonzero(rank == best)
            # leftmost of overlapping occurrences: every second one of a run
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            first = at[run][np.cumsum(run) - 1]
            take = (at - first) % 2 == 0
            one = self.careful[best[at]]
            if one.any():
                lead = np.concatenate([[True], word[at][1:] != word[at][:-1]])
                take &= ~one | lead
            at = at[take]
            sym[at] = made[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            new = np.cumsum(stay)[at] - 1
            sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
            for near in (new, new[new > 0] - 1):  # pairs that changed: of the piece, and before it
                rank[near] = _NONE
                near = near[near + 1 < len(sym)]
                near = near[word[near] == word[near + 1]]
                rank[near], made[near] = self._pairs(sym[near], sym[near + 1])
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        by = np.argsort(word, kind="stable")
        return sym[by], np.bincount(word, minlength=len(words))

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each): other characters become their bytes' ids."""
        sym, lens = self._merge_words(words)
        other = np.flatnonzero(sym >= self.size)
        if not len(other):
            return sym.astype(np.int32), lens
        if not self.byte_fallback:
            sym[other] = self.byte_id[0]
            return sym.astype(np.int32), lens
        texts = [chr(c).encode() for c in (sym[other] - self.size).tolist()]
        width = np.ones(len(sym), np.int64)
        width[other] = [len(t) for t in texts]
        out = np.repeat(sym, width)
        starts = (np.cumsum(width) - width)[other]
        at = np.repeat(starts, width[other]) + np.concatenate([np.arange(len(t)) for t in texts])
        out[at] = self.byte_id[np.frombuffer(b"".join(texts), np.uint8)]
        word = np.repeat(np.repeat(np.arange(len(words)), lens), width)
        return out.astype(np.int32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of each)."""
        lead = SPACE if self.dummy_prefix else ""
        words, per_text = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                found = self.word.findall(lead + t.replace(" ", SPACE))
                per_text[i] = len(found)
                words += found
        ids, lens = self.memory.lookup(words)
        text = np.repeat(np.arange(len(texts)), per_text)
        return ids, np.bincount(text, weights=lens, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of the id lists that lie one after another in ``ids``."""
        ids = np.asarray(ids, np.int64)
        data, lens = _gather(self.piece_bytes, self.piece_offs, ids)
        offs = np.concatenate([[0], np.cumsum(lens)])
        ends = np.cumsum(counts)
        silent = np.flatnonzero(self.control[ids])  # bytes don't join across a control piece
        data, out = data.tobytes(), []
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            cuts = offs[silent[np.searchsorted(silent, a):np.searchsorted(silent, b)]].tolist()
            lead = a
            while lead < b and self.control[ids[lead]]:
                lead += 1
            start = offs[lead] + 1 if self.dummy_prefix and lead < b and self.leads[ids[lead]] \
                else offs[a]
            edges = [start, *(x for x in cuts if x > start), offs[b]]
            out.append("".join(data[x:y].decode("utf-8", "piece_bytes")
                               for x, y in zip(edges, edges[1:])))
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: the ids of its whole text and the text decoded
    from these ids.  Null is an empty text, which has no ids; repeated rows and other
    columns don't matter.  Rows don't shuffle; texts pass in slices of about a quarter
    megabyte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        try:
            for batch in batches:
                for a, b in slices(batch.column(1), SLICE_BYTES):
                    part = batch.slice(a, b - a)
                    ids, counts = c.encode(part.column(1).to_pylist())
                    offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.ListArray.from_arrays(pa.array(offs), pa.array(ids)),
                         pa.array(c.decode(ids, counts), pa.string())], ["doc_id", "ids", "decoded"])
        finally:
            c.forget()  # the worker outlives the task

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode_decode``'s rows."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
