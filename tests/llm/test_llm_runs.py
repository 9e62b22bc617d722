"""Operator 11 against a search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import chunkwise.llm.runs as R
from chunkwise.llm.common import table
from chunkwise.llm.queries import QUERIES, plant_repeats

from conftest import SF_CHECK
from llm_fixtures import edge, empty  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words: list) -> list[tuple]:
    """(start, length, period): for each period, the stretches in which it holds; of the same
    stretch, the smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k - i + q >= max(6, 4 * q) and k > i:
                found.setdefault((i, k - i + q), q)
            i = k + 1
    return sorted((a, length, q) for (a, length), q in found.items())


def collapse(words: list, runs: list[tuple]) -> str:
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed: int, n: int) -> list[str]:
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = [rng.choice("abcdefg"[:rng.choice([1, 2, 2, 3, 7])]) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3) if words else 0):
            a = rng.randrange(len(words))
            p, end = 1 + rng.randrange(max(1, (len(words) - a) // 3)), rng.randint(a, len(words))
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    return out


@pytest.mark.parametrize("piece", [1 << 16, 1000, 31, 1])
def test_runs_equal_brute_force_however_words_are_appended(monkeypatch, piece):
    monkeypatch.setattr(R, "APPEND", piece)
    some = texts(piece, 400 if piece > 1 else 40) + [None, "", " \n", "a", "a a a a a", "a a a a a a", "A a A a A a A a"]
    runs, collapsed = R.runs_of(pa.array(some))
    for text, found, rest in zip(some, runs.to_pylist(), collapsed.to_pylist()):
        words = WORDS.findall(text or "")
        want = brute(words)
        assert [(r["start"], r["length"], r["period"]) for r in found] == want, text
        assert rest == collapse(words, want)


def test_runs_are_known_at_every_moment():
    """After each appended word, the runs are those of the words so far."""
    words = np.array([1, 2, 1, 2, 1, 2, 1, 2, 1, 3, 3, 3, 3, 3, 3, 3, 1, 2, 1, 2])
    catchers = R.Catchers(len(words), len(words))
    for k, word in enumerate(words):
        catchers.append(np.array([word]))
        start, length, period = catchers.runs()
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute(words[:k + 1].tolist())


def test_long_texts_and_many_runs():
    rng = random.Random(5)
    long = ["x"] * 3000
    nested = (["a"] * 40 + ["b"]) * 30
    spaced = [w for k in range(400) for w in ["y"] * 7 + [f"n{k}"]]
    varied = [rng.choice("ab") for _ in range(4000)]
    some = [" ".join(x) for x in (long, nested, spaced, varied, long + nested)]
    runs, _ = R.runs_of(pa.array(some))
    for text, found in zip(some, runs.to_pylist()):
        assert [(r["start"], r["length"], r["period"]) for r in found] == brute(text.split())


def test_a_misleading_hash_changes_nothing(monkeypatch):
    """With a hash of no information every comparison by it passes; the runs stay right."""
    some = texts(9, 60)
    want, _ = R.runs_of(pa.array(some))
    monkeypatch.setattr(R, "mix64", lambda x: x * np.uint64(0))
    got, _ = R.runs_of(pa.array(some))
    assert got.to_pylist() == want.to_pylist()


def test_least_periods():
    with pytest.raises(ValueError):
        R.find_runs(None, least_periods=3)


def test_planted_repeats_and_query_against_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents")
    want, planted = {}, {}
    for r in docs.collect():
        words = WORDS.findall(r["text"] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted[r["doc_id"]] = words
        runs = brute(words)
        lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        best = (None,) * 4
        if runs:
            a, length, q = runs[0]
            for x in runs[1:]:
                if x[1] * q > length * x[2] or (x[1] * q == length * x[2] and (x[0], x[2]) < (a, q)):
                    a, length, q = x
            best = (a, length, q, 1000 * length // q)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[r["doc_id"]] = (len(runs), *best, sha(lines), sha(collapse(words, runs)))
    assert planted and sum(w[0] for w in want.values()) > 50
    for r in plant_repeats(docs).filter("crc32(cast(doc_id as string)) % 10 = 0").collect():
        if r["doc_id"] in planted:
            assert r["text"] == " ".join(planted[r["doc_id"]])
    got = QUERIES["op11_catch_runs"](spark, SF_CHECK)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_edge_rows(spark, edge, empty):
    got = R.find_runs(edge).collect()
    rows = edge.collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["collapsed"]) for r in got) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, " ".join(WORDS.findall(r["text"] or ""))) for r in rows)
    assert not any(r["runs"] for r in got)
    assert R.find_runs(empty).collect() == []
    assert plant_repeats(edge).count() == len(rows)


def test_no_row_is_shuffled(spark, edge):
    plan = R.find_runs(edge.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
