import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chunkwise.llm.piece_codec import PieceCodec, WordMemory, digests, encode_decode
from chunkwise.llm.token_orc import CachedEncoder, lookup, read_token_files, tokenize_to_orc, write_token_files
from chunkwise.session import scratch_path

from llm_fixtures import edge, empty  # noqa: F401

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pieces():
    return PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def encoder():
    return CachedEncoder(BYTES), Tokenizer.from_file(BYTES)


SYMBOLS = [*" ▁aabehtnos.\n\t'中é😀\x00<>|9", "  ", "the", "<s>", "<|endoftext|>", "\xa0", "\x1c",
           "\r\n", " 's"]
texts = st.lists(st.sampled_from(SYMBOLS), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5))
def test_pieces_equal_the_library(pieces, some):
    mine, lib = pieces
    ids, n = mine.encode(some)
    want = [lib.encode(t) for t in some]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == want
    assert mine.decode(ids, n) == [lib.decode(w) for w in want]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_in_the_library(pieces, ids):
    mine, lib = pieces
    assert mine.decode(np.array(ids, np.int64), np.array([len(ids)])) == [lib.decode(ids)]


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5))
def test_bytes_equal_the_library(encoder, some):
    mine, lib = encoder
    ids, n = mine.encode(some)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == \
        [e.ids for e in lib.encode_batch(some, add_special_tokens=False)]


def test_line_starts_and_indents_need_no_call_of_their_own(encoder, monkeypatch):
    words = [a + b for a in "qwrtpsdfghjklz" for b in "qwrtpsdfghjklz"]
    some = ["".join(f"{lead}{w}" for w in words) for lead in ("\n", "  ", "\n\n   ", " \n", " ")]
    some += ["  a", "a  ", "\n", " \n \n", "\na\n", "    a\n  b \n c"]
    mine, asked = CachedEncoder(BYTES), []
    whole = mine._whole
    monkeypatch.setattr(mine, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    ids, n = mine.encode(some)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == \
        [e.ids for e in encoder[1].encode_batch(some, add_special_tokens=False)]
    assert len(asked) < 20 < len(words)


def test_words_are_looked_up_once_a_slice_and_plain_ones_skip_pre_tokenization(encoder, monkeypatch):
    words = [a + b + c for a in "qwrtpsdfghjklz" for b in "aeiouéß" for c in "nrst"]
    some = [" ".join(w + mark for w in words for mark in ("", ",", "..", "?!", ")]")) for _ in range(20)]
    some += ["it's don't, 'tis 's. a'b", "x1, 2.5% a_b `c` ~d~ e^f", "word\nLine, next\nline.", "ﬁ ª µ ǅ ñ́"]
    mine, asked, looked = CachedEncoder(BYTES), [], []
    whole, lookup_ = mine._whole, mine.memory.lookup
    monkeypatch.setattr(mine, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    monkeypatch.setattr(mine.memory, "lookup", lambda keys: looked.extend(keys) or lookup_(keys))
    ids, n = mine.encode(some)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == \
        [e.ids for e in encoder[1].encode_batch(some, add_special_tokens=False)]
    assert len(looked) == len(set(looked)) < 5 * len(words) + 50
    assert sum(len(t) for t in asked) < 300


def test_white_space_around_added_tokens(encoder):
    for lead in ("", " ", "\n", "  ", "\n\n", " \n", "\n "):
        texts = [f"{lead}<|endoftext|>{lead}a", f"a{lead}<|endoftext|>{lead}", f"b{lead}a"]
        ids, n = encoder[0].encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == \
            [e.ids for e in encoder[1].encode_batch(texts, add_special_tokens=False)]


def test_memory_sheds_without_changing_ids(pieces):
    rng = random.Random(2)
    memory = WordMemory(lambda ws: (ws, *pieces[0]._encode_words(ws)), 50)
    for _ in range(30):
        words = ["▁" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(40)]
        ids, n = memory.lookup(words)
        flat, lens = pieces[0]._encode_words(words)
        assert ids.tolist() == flat.tolist() and n.tolist() == lens.tolist()
    assert len(memory.known) <= 50 + 40


def test_long_texts(pieces, encoder):
    rng = random.Random(1)
    some = ["".join(rng.choice("etaoin shr") for _ in range(30_000)), "ab" * 20_000, " " * 5000, "\n" * 3000]
    for (mine, lib), enc in ((pieces, lambda t: pieces[1].encode(t)),
                             (encoder, lambda t: encoder[1].encode(t, add_special_tokens=False).ids)):
        ids, n = mine.encode(some)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]] == [enc(t) for t in some]


def test_digests_of_edge_rows(edge, pieces):
    lib = pieces[1]
    got = sorted(map(tuple, digests(encode_decode(edge, PIECES)).collect()), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in edge.collect():
        ids = lib.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    assert got == sorted(want, key=repr)


def test_orc_files_of_edge_rows(spark, edge, encoder):
    lib = encoder[1]
    rows = {}
    for r in edge.collect():
        rows.setdefault(r["doc_id"], []).append(
            lib.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    got, at = tokenize_to_orc(edge, BYTES).orderBy("start").collect(), 0
    assert [g["doc_id"] for g in got] == sorted((r["doc_id"] for r in edge.collect()),
                                                key=lambda i: (i is not None, i or 0))
    for g in got:
        assert g["start"] == at
        assert (g["n_tokens"], g["ids_crc32"]) in {
            (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in rows[g["doc_id"]]}
        at += g["n_tokens"]


def test_orc_round_trip_and_pruned_lookup(spark, edge, encoder):
    path = scratch_path(spark, "orc-test")
    write_token_files(edge, path, BYTES)
    ids = {r["doc_id"]: r["ids"] for r in read_token_files(spark, path).collect()}
    assert ids[203] == encoder[1].encode("One two").ids + [0] and ids[200] == [0]
    found = lookup(spark, path, [203, 205])
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == {i: ids[i] for i in (203, 205)}
    assert "PushedFilters: [In(doc_id, [203,205])]" in found._jdf.queryExecution().executedPlan().toString()


def test_empty(empty):
    assert tokenize_to_orc(empty, BYTES).count() == 0
    assert encode_decode(empty, PIECES).count() == 0
