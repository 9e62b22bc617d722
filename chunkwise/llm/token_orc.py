"""Token ids in ORC files (operator 6).

One range shuffle deals the documents by doc_id; each task sorts its range, encodes it and
writes it, so the files, in the order of their parts, hold all ids in ascending doc_id
order.  ORC stores the ids with its integer run-length encoding; stripes are split over
readers, and row indexes and a Bloom filter on doc_id let a lookup skip the rest.

A text is cut where the tokenizer's own pre-tokenization always cuts: a word with the blank
before it is a piece, and so is the white space before that; each distinct piece is encoded
once per task by the tokenizers library.  Arrow splits and counts the words of a slice, so
that Python sees each distinct one once; plain words go to the library's model itself, all
others through the whole library, many in one call.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from chunkwise.session import scratch_path

from .common import id_text, slices
from .piece_codec import WordMemory, _gather

END_ID = 0
#: Distinct pieces that a task remembers.
REMEMBERED = 600_000
#: Words in one call of the library: its cost a word grows with the text.
PER_CALL = 100
#: Bytes of text encoded at once: the more, the fewer of its words are looked up.
SLICE_BYTES = 2 << 20
ORC_OPTIONS = {"compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "1000",
               "orc.stripe.size": str(16 << 20), "orc.bloom.filter.columns": "doc_id",
               "orc.bloom.filter.fpp": "0.01"}
SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"

#: A word with one blank before it; white space but its last character before a word, or all
#: of it at the end; a line feed before a word.
_PIECE = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|\n")
#: White space of any tokenizer beyond blank and line feed (in RE2): such texts are encoded whole.
_OTHER_SPACE = (r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
                r"\x{205f}-\x{2064}\x{3000}\x{feff}]")
#: No text, or white space at its ends or more than one character long: cut by ``_PIECE``.
_UNEVEN = r"\A(?:[ \n]|\z)|[ \n][ \n]|[ \n]\z"
#: ASCII characters that are no letters, digits, blanks or apostrophes: after a letter, a run
#: of them is a pre-token.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Letters of any Unicode version.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c not in "\xaa\xb5\xba")
#: Two pre-tokens (in RE2): letters, and a run of marks or nothing.
_PLAIN = rf"\A[A-Za-zÀ-ÖØ-öø-ɏ]+[{re.escape(_MARKS)}]*\z"
_ID = attrgetter("id")


class CachedEncoder:
    """The library's ids of whole texts, from the ids of their distinct pieces.

    A piece is remembered by a key: a word after a blank by itself, a word after a line feed
    with the line feed, anything else (first words, white space) after a carriage return,
    which no text that is cut holds.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        before, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        # pieces are joined by line feeds, which must be one id and stand for nothing else
        self.by_piece = (len(line) == 1 and isinstance(before, pre_tokenizers.ByteLevel)
                         and self.tokenizer.normalizer is None
                         and not before.add_prefix_space and before.use_regex
                         and isinstance(self.model, models.BPE) and not self.model.dropout)
        self.line = line[0] if line else -1
        # the library cuts at these first, so white space before them ends its own text:
        # texts with one are encoded whole
        self.added = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        # the model reads bytes as characters of the library's own
        chars = "".join(map(chr, range(0x800)))
        self.as_char = dict(zip(chars.encode(), pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False).pre_tokenize_str(chars)[0][0]))
        self.memory = WordMemory(self._learn, REMEMBERED)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each) of words that are one pre-token each, without line feeds."""
        chars = "\n".join(words).encode().decode("latin-1").translate(self.as_char)
        chars, ids, n = chars.split(self.as_char[10]), [], []
        for at in range(0, len(words), PER_CALL):
            tokens = list(map(self.model.tokenize, chars[at:at + PER_CALL]))
            n += map(len, tokens)
            ids.append(np.fromiter(map(_ID, chain.from_iterable(tokens)), np.int32))
        return np.concatenate(ids), np.array(n, np.int64)

    def _learn(self, keys: list[str]):
        values = pa.array(keys, pa.large_string())
        plain = pc.match_substring_regex(values, _PLAIN)
        values = values.filter(plain)
        plain = plain.to_numpy(zero_copy_only=False)
        other = [k for k, p in zip(keys, plain.tolist()) if not p]
        out = [self._learn_others(other)] if other else []
        if len(values):
            trimmed = pc.utf8_rtrim(values, _MARKS)
            words = trimmed.dictionary_encode()
            tailed = pc.not_equal(values, trimmed)
            tails = pc.utf8_ltrim(values.filter(tailed), _LETTERS).dictionary_encode()
            ids, lens = self._of_model([" " + w for w in words.dictionary.to_pylist()]
                                       + tails.dictionary.to_pylist())
            # each key's word, followed by its tail if it has one
            tailed = tailed.to_numpy(zero_copy_only=False)
            which = np.insert(words.indices.to_numpy(), np.flatnonzero(tailed) + 1,
                              len(words.dictionary) + tails.indices.to_numpy())
            ids, lens = _gather(ids, np.concatenate([[0], np.cumsum(lens)]), which)
            starts = np.arange(len(tailed)) + np.cumsum(tailed) - tailed
            out.insert(0, (ids, np.add.reduceat(lens, starts)))
        return (values.to_numpy(zero_copy_only=False).tolist() + other,
                np.concatenate([i for i, _ in out]), np.concatenate([n for _, n in out]))

    def _learn_others(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # white space would run into the line feeds between the pieces: one run is one token;
        # a line feed before a word is encoded apart from it
        pieces = [k[1:] if k[0] in "\r\n" else " " + k for k in keys]
        out = [np.zeros(0, np.int32)] * len(keys)
        plain = [i for i, p in enumerate(pieces) if p.strip(" \n")]
        for at in range(0, len(plain), PER_CALL):  # joined, each call returns one long id list
            part = [pieces[i] for i in plain[at:at + PER_CALL]]
            ids = self._whole(["\n".join(part)])[0]
            cuts = np.flatnonzero(ids == self.line)
            got = ([x[1:] if k else x for k, x in enumerate(np.split(ids, cuts))]
                   if len(cuts) == len(part) - 1 else self._whole(part))
            for i, x in zip(plain[at:at + PER_CALL], got):
                out[i] = np.append(np.int32(self.line), x) if keys[i][0] == "\n" else x
        rest = [i for i, p in enumerate(pieces) if not p.strip(" \n")]
        for i, x in zip(rest, self._whole([pieces[i] for i in rest])):
            out[i] = x
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of each)."""
        values = pa.array(texts, pa.large_string())
        kind = np.full(len(texts), 2)  # 0: even, 1: cut by _PIECE, 2: whole
        if self.by_piece:
            uneven, whole = (pc.match_substring_regex(values, p).to_numpy(zero_copy_only=False)
                             for p in (_UNEVEN, _OTHER_SPACE))
            for token in self.added:
                whole |= pc.match_substring(values, token).to_numpy(zero_copy_only=False)
            kind = np.where(whole, 2, uneven.astype(np.int64))
        ways = (self._encode_even, self._encode_uneven, self._encode_whole)
        present = np.unique(kind).tolist()
        if len(present) == 1:
            return ways[present[0]](texts)
        lists = [np.zeros(0, np.int32)] * len(texts)
        for k in present:
            at = np.flatnonzero(kind == k).tolist()
            ids, n = ways[k]([texts[i] for i in at])
            for i, x in zip(at, np.split(ids, np.cumsum(n)[:-1])):
                lists[i] = x
        return (np.concatenate([np.zeros(0, np.int32), *lists]),
                np.array([len(x) for x in lists], np.int64))

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._whole(texts)
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)

    def _encode_uneven(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys, per_text = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            found = [p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n") else "\r" + p
                     for p in _PIECE.findall(t)]
            per_text[i] = len(found)
            keys += found
        ids, lens = self.memory.lookup(keys)
        text = np.repeat(np.arange(len(texts)), per_text)
        return ids, np.bincount(text, weights=lens, minlength=len(texts)).astype(np.int64)

    def _encode_even(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts of words with one blank or line feed between two."""
        joined = pa.array([("\r" + " \r".join(texts)).replace("\n", " \n")], pa.large_string())
        words = pc.split_pattern(joined, " ").flatten().dictionary_encode()
        which = words.indices.to_numpy()
        first = pc.starts_with(words.dictionary, "\r").to_numpy(zero_copy_only=False)
        ids, lens = self.memory.lookup(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        starts = np.flatnonzero(first[which])
        ids, lens = _gather(ids, np.concatenate([[0], np.cumsum(lens)]), which)
        return ids, np.add.reduceat(lens, starts)


@lru_cache(maxsize=2)
def encoder(path: str) -> CachedEncoder:
    return CachedEncoder(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write ORC files.

    Rows are ordered by doc_id (null first), then by a hash of the text; the range shuffle
    also ranges over a row number, so that no repeated row makes a range too large.  Each
    row has its ``part`` and the number of ids before it in that part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                rows = batch.slice(a, b - a)
                ids, n = enc.encode(rows.column(1).to_pylist())
                ends = np.cumsum(n + 1)
                out = np.full(len(ids) + len(n), end_id, np.int32)
                keep = np.ones(len(out), bool)
                keep[ends - 1] = False
                out[keep] = ids
                offs = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)),
                     pa.array(start + offs[:-1]), pa.array(n + 1),
                     pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(out))],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                start += len(out)

    order = ["doc_id", "_hash", "_row"]
    (id_text(docs, id_col, text_col)
     .withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(run, SCHEMA).write.options(**ORC_OPTIONS).orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: ``start`` ids stand before it."""
    rows = spark.read.schema(SCHEMA).orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per file
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents; files, stripes and row groups without them are
    skipped by ORC's statistics and Bloom filters."""
    return (spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids))
            .select("doc_id", "ids"))


@F.arrow_udf(LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each id list as little-endian unsigned 32-bit integers."""
    offs = ids.offsets.to_numpy()
    flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<u4")).cast("B")
    return pa.array([zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(offs[:-1], offs[1:])],
                    pa.int64())


def tokenize_to_orc(docs: DataFrame, tokenizer_path: str, path: str | None = None,
                    **columns) -> DataFrame:
    """Write the token files (to a new shared folder unless ``path`` is given) and return
    (doc_id, start, n_tokens, ids_crc32) as read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-orc")
    write_token_files(docs, path, tokenizer_path, **columns)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))
