"""Operator 12 against counts made word by word, and what the learned lists do."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from chunkwise.llm import decision_list as D
from chunkwise.llm.common import table
from chunkwise.llm.queries import QUERIES

from conftest import SF_CHECK
from llm_fixtures import edge, empty, labels  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_of_texts(spark):
    rng = random.Random(2)
    texts = [None, "", " ", "a", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "a b c d a b c",
             "x\ny\nx\n\n \n\r\nx\r", "Ä ä\x0bß\x0cñ\r\nÄ ä", "# $ % & * | < > ! ?", "   a"]
    texts += [rng.choice([" ", "\n", " \t"]).join(rng.choice("abcd"[:rng.randint(1, 4)])
                                                  for _ in range(rng.randint(1, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = D.text_statistics(df).withColumn("failed", D.base_failed()).collect()
    assert {r["doc_id"]: (*[r[c] for c in BASE], r["failed"]) for r in got} == {
        i: brute(t) for i, t in enumerate(texts)}


def test_query_against_brute_force_and_labels(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_CHECK, "documents").collect()}
    got = QUERIES["op12_decision_list"](spark, SF_CHECK)
    assert got.columns[:8] == ["doc_id", *BASE, "base_failed", "kept"]
    found = {r["doc_id"]: r for r in got.collect()}
    assert set(found) == set(docs)
    for i, text in docs.items():
        r = found[i]
        assert (*[r[c] for c in BASE], r["base_failed"]) == brute(text)
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)
    told = [(r["quality"], found[r["doc_id"]]) for r in table(spark, SF_CHECK, "labels").collect()]
    good = [r for q, r in told if q == 1 and not r["base_failed"]]
    bad = [r for q, r in told if q == 0 and not r["base_failed"]]
    assert all(r["kept"] for r in good) and sum(r["kept"] for r in bad) <= 0.05 * len(bad)


def _labelled(spark, rows):
    names = ["doc_id", "bad", *D.FEATURES]
    out = [(i, bad, *[float(values.get(f, 0)) for f in D.FEATURES]) for i, bad, values in rows]
    return spark.createDataFrame(out, "doc_id bigint, bad boolean, "
                                 + ", ".join(f"{f} double" for f in names[2:]))


def _rows(n, seed=1):
    """Bad are texts with many symbols, and long ones of short words; either alone is fine."""
    rng, out = random.Random(seed), []
    for i in range(n):
        v = {"symbol_share": rng.random(), "n_words": rng.randint(50, 1000), "mean_word": 2 + 6 * rng.random(),
             "upper_share": rng.random()}
        out.append((i, v["symbol_share"] >= 0.8 or (v["n_words"] >= 700 and v["mean_word"] < 4), v))
    return out


def test_conjunctions_are_learned_in_order(spark):
    rules = D.Learner(_labelled(spark, _rows(3000))).learn(least_precision=0.9)
    assert len(rules) >= 2 and any(len(r.conditions) > 1 for r in rules)
    fresh = _rows(2000, seed=2)
    verdict = _labelled(spark, fresh).withColumn("rule", D.decide(rules)).collect()
    wrong = [r for r in verdict if (r["rule"] is not None) != r["bad"]]
    assert len(wrong) <= 0.06 * len(fresh)
    by_hand = {}
    for i, _, v in fresh:       # the list, condition by condition
        by_hand[i] = next((str(rule) for rule in rules if all(
            (v.get(c.feature, 0) >= c.cut) == c.above for c in rule.conditions)), None)
    assert by_hand == {r["doc_id"]: r["rule"] for r in verdict}


def test_counts_and_gains_against_brute_force(spark):
    rows = _rows(400, seed=3)
    learner = D.Learner(_labelled(spark, rows))
    counts = learner._counts(learner.rows)
    best = (0, None)
    grow = [(bad, v) for i, bad, v in rows if zlib.crc32(str(i).encode()) % D.PRUNE_ONE_IN]
    p0 = sum(b for b, _ in grow)
    for f in D.FEATURES:
        for cut in learner.cuts[f]:
            for above in (True, False):
                held = [b for b, v in grow if (v.get(f, 0) >= cut) == above]
                gain = D._gain(sum(held), len(held) - sum(held), p0, len(grow) - p0)
                if gain > best[0] + 1e-9:
                    best = (gain, D.Condition(f, above, cut))
    assert learner._best(counts) == best[1]
    assert learner._total(counts, False) == (p0, len(grow) - p0)


@pytest.mark.parametrize("bad", [[], [True] * 30, [False] * 30, [k % 2 == 0 for k in range(60)]])
def test_labels_that_teach_nothing(spark, bad):
    """No labels, one class, labels at random: no rule."""
    rng = random.Random(6)
    rows = [(i, b, {"symbol_share": rng.random(), "n_words": 60}) for i, b in enumerate(bad)]
    assert D.Learner(_labelled(spark, rows)).learn() == []


def test_edge_rows(spark, edge, empty, labels):
    rows = edge.collect()
    got = D.judge_quality(edge, labels).collect()
    base = lambda t: brute(t)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), *[r[c] for c in BASE], r["base_failed"])
                  for r in got) == sorted(((r["doc_id"] is None, r["doc_id"] or 0), *base(r["text"])) for r in rows)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert D.judge_quality(empty, labels).collect() == []
    none = D.judge_quality(edge, labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in none)


def test_no_python_on_the_main_path(spark, edge):
    stats = D.text_statistics(edge.select("doc_id", "text"))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.replace("Exchange Round", "")
    rule = D.Rule((D.Condition("n_words", True, 3.0),))
    plan = stats.select(D.decide([rule]))._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan
    assert stats.agg(F.count(F.lit(1))).first()[0] == edge.count()
