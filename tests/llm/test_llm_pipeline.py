import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from chunkwise.llm import bloom_dedup, cotrain
from chunkwise.llm.common import stored, table
from chunkwise.llm.cotrain import score_quality
from chunkwise.llm.mixing import mix

from conftest import SF_CHECK
from llm_fixtures import CLASHING, edge, empty  # noqa: F401
from test_llm_join import brute, keepers, ordered, shingles

UPPER = re.compile("[A-Z]")


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents")
    labels = table(spark, SF_CHECK, "labels")
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_filter", "exact_dedup", "near_dedup", "source_mix", "encode_pieces"]
    out = {}
    for name, stage in cp.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_CHECK), f"test-{name}")
        out[name] = docs
        if name != "encode_pieces":
            assert docs.columns == before.columns
        old = {r["doc_id"]: r for r in before.collect()}
        new = [r for r in docs.collect()]
        if name == "quality_filter":
            good = score_quality(before, labels).filter("predicted = 1")
            assert sorted(r["doc_id"] for r in new) == sorted(r["doc_id"] for r in good.collect())
            bad = {r["doc_id"] for r in labels.filter("quality = 0").collect()}
            assert len(bad & {r["doc_id"] for r in new}) <= 0.05 * len(bad)
        elif name == "exact_dedup":
            last = {}
            for i, r in sorted(old.items()):
                last[UPPER.sub(lambda m: m[0].lower(), r["text"] or "")] = i
            assert sorted(r["doc_id"] for r in new) == sorted(last.values())
        elif name == "near_dedup":
            texts = [(i, r["text"]) for i, r in old.items()]
            keep = [i for i, n, c, _ in brute(texts, percent=80, width=5) if i == c or not n]
            assert sorted(r["doc_id"] for r in new) == sorted(keep)
        elif name == "source_mix":
            want = {r["doc_id"]: r["taken"] for r in mix(before).collect() if r["taken"]}
            got = {}
            for r in new:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            assert got == want
        else:
            lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
            want = []
            for r in before.collect():
                ids = lib.encode(r["text"])
                want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
            assert sorted(map(tuple, new)) == sorted(want)


def test_near_dedup_at_five_words_and_four_fifths(spark):
    """Appended paragraphs and scattered edits, on both sides of 0.8 of five-word shingles."""
    rng = random.Random(8)
    rows = []
    for k in range(12):
        words = [f"d{k}w{j}" for j in range(250)]
        rows.append((100 * k, " ".join(words)))
        for j, more in enumerate((30, 50, 61, 62, 63, 80)):
            rows.append((100 * k + 1 + j, " ".join(words + [f"d{k}a{j}m{i}" for i in range(more)])))
        for j, edits in enumerate((3, 5, 6, 9)):
            changed = list(words)
            for at in rng.sample(range(250), edits):
                changed[at] = f"d{k}e{j}at{at}"
            rows.append((100 * k + 20 + j, " ".join(changed)))
    sets = [shingles(t, 5) for _, t in rows]
    near = [[b for b in range(len(rows)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            for a in range(len(rows))]
    keep, seen = [], set()
    for a in range(len(rows)):
        if a not in seen:
            todo, group = [a], set()
            while todo:
                b = todo.pop()
                if b not in group:
                    group.add(b)
                    todo += near[b]
            seen |= group
            keep.append(min(rows[b][0] for b in group))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(r["doc_id"] for r in cp.near_dedup(spark, docs, SF_CHECK).collect())
    assert got == sorted(keep)
    at_four = [i for i, _, c, _ in brute(rows) if i == c]
    assert set(got) < set(at_four)


def _counted(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_on_edge_rows(spark, edge, empty):
    """Each stage over null and repeated ids, null, empty, blank, long and tied texts."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = stored(edge.select(*cols), "edge-docs")
    old = docs.collect()
    out = {name: stage(spark, docs, SF_CHECK).collect() for name, stage in cp.STAGES}
    low = lambda t: UPPER.sub(lambda m: m[0].lower(), t or "")

    scores = score_quality(docs, table(spark, SF_CHECK, "labels")).collect()
    assert Counter(r["doc_id"] for r in out["quality_filter"]) == \
        Counter(r["doc_id"] for r in scores if r["predicted"])
    assert not _counted(out["quality_filter"]) - _counted(old)

    best = {}
    for r in old:
        at = (r["doc_id"] is not None, r["doc_id"] or 0)
        best[low(r["text"])] = max(best.get(low(r["text"]), at), at)
    assert Counter((low(r["text"]), r["doc_id"]) for r in out["exact_dedup"]) == \
        Counter((t, i if known else None) for t, (known, i) in best.items())
    assert not _counted(out["exact_dedup"]) - _counted(old)

    texts = [(r["doc_id"], r["text"]) for r in old]
    assert ordered((r["doc_id"], r["text"]) for r in out["near_dedup"]) == \
        keepers(texts, percent=80, width=5)

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, got = Counter(), Counter()
    for r in mix(docs).collect():
        want[r["doc_id"]] += r["taken"]
    for r in out["source_mix"]:
        got[r["doc_id"]] += size(r["text"])
    assert +want == +got
    assert all(size(r["text"]) for r in out["source_mix"])

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter()
    for i, text in texts:
        ids = lib.encode(text or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids) if ids else ""))] += 1
    assert _counted(out["encode_pieces"]) == want

    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF_CHECK).count() == 0


def test_stages_keep_columns_with_clashing_names(spark, edge):
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, edge, SF_CHECK)
        assert got.columns == edge.columns
        assert all(r[c] == f"extra {c}" for r in got.collect() for c in CLASHING)


def test_tasks_of_the_first_stages_need_one_python_worker(spark, edge, monkeypatch):
    def evals(df):
        return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")

    assert evals(bloom_dedup.drop_copies(edge)) == 2  # two sides of a union, one each
    seen, fit = [], cotrain._fit
    monkeypatch.setattr(cotrain, "_fit", lambda rows, *a: seen.append(evals(rows)) or fit(rows, *a))
    cotrain.keep_good(table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels"))
    assert seen and max(seen) == 1
