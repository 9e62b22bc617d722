import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chunkwise.llm import toxicity
from chunkwise.llm import bidi_lm
from chunkwise.llm.bidi_lm import Vocabulary, WindowNetwork, padded, places, pseudo_likelihood, word_counts
from chunkwise.llm.common import table, word_hashes
from chunkwise.llm import cotrain
from chunkwise.llm.cotrain import keep_good, score_quality, text_features
from chunkwise.llm.toxicity import FactorizationMachine, doc_terms, score_toxicity

from llm_fixtures import edge, empty, labels, prose  # noqa: F401


def held_out_accuracy(found, truth):
    rows = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert rows
    return sum(a == b for a, b in rows) / len(rows)


def made(spark, n=900, bad="slur"):
    """Documents of which every fifth holds one of a few bad words or is full of marks."""
    rng = random.Random(9)
    rows, truth = [], {}
    for i in range(n):
        words = prose(rng, 60).split()
        truth[i] = int(i % 5 == 0)
        if truth[i]:
            for _ in range(3):
                words[rng.randrange(60)] = bad + rng.choice(("s", "ish", ""))
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string"), truth


def test_toxicity_on_held_out_rows(spark, labels):
    docs, truth = made(spark)
    known = spark.createDataFrame([(i, t) for i, t in truth.items()], "doc_id long, toxic int")
    found = score_toxicity(docs, known).collect()
    assert len(found) == 900
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert held_out_accuracy(found, truth) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs, truth = made(spark, 300)
    out = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    frames = [spark.createDataFrame([(i, 1 - t if flip and i in out else t) for i, t in truth.items()],
                                    "doc_id long, toxic int") for flip in (False, True)]
    a, b = (sorted(map(tuple, score_toxicity(docs, f).collect())) for f in frames)
    assert a == b


def test_pairs_of_terms_are_learned():
    """Toxic only if both words meet: no linear score tells these apart."""
    rng = np.random.default_rng(0)
    docs, y = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        d = [1] * a + [2] * b + list(rng.integers(10, 40, 3))
        docs.append(np.unique(np.array(d, np.uint32)))
        y.append(float(a and b))
    m = FactorizationMachine.train(docs, np.array(y), np.ones(len(y)))
    p = m.score([np.array(d, np.uint32) for d in ([1], [2], [1, 2])])
    assert p[2] > 0.5 > max(p[0], p[1])


def test_pairs_without_evidence_of_their_terms():
    """Two words as frequent in toxic as in clean documents, toxic only together."""
    rng = np.random.default_rng(3)
    docs, y = [], []
    for i in range(6000):
        toxic, u = i % 2, rng.random()
        some = [1, 2] if toxic and u < 0.1 else [1] if u < 0.1 else [2] if u < 0.2 and not toxic else []
        # the other toxic documents have a word of their own
        some += [3] if toxic and len(some) < 2 else []
        docs.append(np.unique(np.array(some + list(rng.integers(10, 2000, 100)), np.uint32)))
        y.append(float(toxic))
    y = np.array(y)
    rate = [[np.mean([w in d for d in docs[k::2]]) for k in (0, 1)] for w in (1, 2)]
    assert all(abs(a - b) < 0.02 for a, b in rate)
    m = FactorizationMachine.train(docs, y, np.where(y == 1, 0.2, 1.8))
    rest = rng.integers(10, 2000, (50, 100)).astype(np.uint32)
    mean = lambda some: m.score([np.unique(np.array(some + list(r), np.uint32)) for r in rest]).mean()
    assert mean([1, 2]) > 0.5 > max(mean([1]), mean([2]), mean([]))


def test_rare_label_keeps_its_documents(spark, monkeypatch):
    """Few toxic documents among many long clean ones: all of them are trained on, and a
    document that takes a whole share of the terms does not end the sample."""
    monkeypatch.setattr(toxicity, "MAX_TERMS", 20_000)
    rng = random.Random(12)
    rows, truth = [], {}
    for i in range(600):
        truth[i] = int(i % 30 == 0)
        rows.append((i, " ".join(f"t{i}" if truth[i] else f"{rng.choice('abcd')}{rng.randrange(10 ** 6)}"
                                 for _ in range(5 if truth[i] else 200))))
    long = [i for i in truth if truth[i] and zlib.crc32(str(i).encode()) % 5][0]
    rows[long] = (long, " ".join(f"l{j}" for j in range(30_000)))
    known = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms, y, weight = toxicity.training_sample(docs, known, "toxic")
    trained = [i for i in truth if truth[i] and i != long and zlib.crc32(str(i).encode()) % 5]
    assert y.sum() == len(trained) and (y == 0).sum() > 10
    assert sum(map(len, terms)) <= 20_000
    known_share = (len(trained) + 1) / sum(1 for i in truth if zlib.crc32(str(i).encode()) % 5)
    assert (weight * y).sum() / weight.sum() == pytest.approx(known_share)


def test_toxicity_edge_rows(spark, edge, empty, labels):
    found = score_toxicity(edge, labels).collect()
    assert len(found) == edge.count() and all(0 <= r["score"] <= 1 for r in found)
    assert {r["predicted"] == (r["score"] >= 0.5) for r in found} == {True}
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[200] == by[201] == by[202]
    assert score_toxicity(empty, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(edge, none).collect()} == {0.5}


def test_terms_are_words_and_prefixes():
    a, b = doc_terms(pa.array(["Loser, losing", "loser losing loser"]))
    assert a.tolist() == b.tolist()
    assert len(a) == 2 + 2 + 1  # words; "lose" "losi"; "losin" ("loser" has no longer form)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = score_quality(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    truth = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert len(found) == 1000 and held_out_accuracy(found, truth) > 0.95
    assert all(0 <= r[c] <= 1 for r in found for c in ("score", "content_score", "metadata_score"))


def test_quality_edge_rows(spark, edge, empty, labels):
    found = score_quality(edge, labels).collect()
    assert len(found) == edge.count() and all(0 <= r["score"] <= 1 for r in found)
    assert score_quality(empty, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = keep_good(edge, none)
    assert kept.columns == edge.columns and kept.count() == edge.count()


def test_text_features_are_whole_text():
    x = text_features(pa.array(["", None, "ab" * 1_500_000, "A b\nA b"]))
    assert len(x) == 4 and np.isfinite(x).all() and (x[0] == x[1]).all()


def test_gradients():
    rng = np.random.default_rng(1)
    net = WindowNetwork([p.astype(float) for p in WindowNetwork.fresh(np.full(1024, 1 / 1024)).parts])
    seq, at, _ = next(padded([rng.integers(0, 1024, 25)], net.pad))
    grads = []
    net.log_probs(seq, at, grads.extend)
    for p, g in zip(net.parts, grads):
        where = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, sides = p[where], []
        for e in (1e-4, -1e-4):
            p[where] = old + e
            sides.append(-net.log_probs(seq, at).mean())
        p[where] = old
        assert g[where] == pytest.approx((sides[0] - sides[1]) / 2e-4, rel=1e-4)


def test_probabilities_sum_to_one():
    net = WindowNetwork.fresh(np.full(1024, 1 / 1024))
    seq, at, _ = next(padded([np.array([5, 9, 700])], net.pad))
    total = 0.0
    for w in range(1024):
        seq[at[1]] = w
        total += np.exp(net.log_probs(seq, at)[1])
    assert total == pytest.approx(1, rel=1e-3)


def test_word_counts(edge):
    words = re.findall(r"[^\x20\x09-\x0D]+", " ".join(
        re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "") for r in edge.collect()))
    got = {r["word"]: r["n"] for r in word_counts(edge.selectExpr("doc_id", "coalesce(text, '') text")).collect()}
    assert sum(got.values()) == len(words) and len(got) == len(set(words))
    some = word_hashes(pa.array(["éa"]))[0].view(np.int64)[0]
    assert got[some] == words.count("éa")


def test_both_sides_help(spark):
    """Words that their neighbours determine score higher than shuffled ones."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{(i + k) % 50}" for k in range(60))) for i in range(400)]
    for i in range(400, 420):
        words = [f"w{k % 50}" for k in range(60)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    found = {r["doc_id"]: r for r in pseudo_likelihood(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered = np.mean([found[i]["mean_log_likelihood"] for i in range(400)])
    mixed = np.mean([found[i]["mean_log_likelihood"] for i in range(400, 420)])
    assert found[0]["n_words"] == 60 and ordered > mixed + 0.5


def test_lm_edge_rows(edge, empty):
    found = pseudo_likelihood(edge).collect()
    assert len(found) == edge.count()
    by = {r["doc_id"]: r for r in found}
    for i in (200, 201, 202):
        assert (by[i]["n_words"], by[i]["log_likelihood"], by[i]["mean_log_likelihood"]) == (0, 0.0, None)
    assert by[208]["n_words"] == 15_000 and by[208]["log_likelihood"] < 0
    assert pseudo_likelihood(empty).count() == 0


def test_vocabulary():
    words = np.arange(800, dtype=np.int64) * 7
    n = np.arange(800, 0, -1)
    slots = np.bincount(words & 255, n, 256)
    v = Vocabulary(words[:768], n[:768], slots, words[700:780], n[700:780])
    ids, logs, known = v.encode(words.view(np.uint64))
    assert v.size == 1024 and ids[:768].tolist() == list(range(768)) and (logs[:768] == 0).all()
    assert (ids[768:] - 768 == (words[768:] & 255)).all()
    assert known.tolist() == [True] * 780 + [False] * 20
    assert v.share.sum() == pytest.approx(1)
    # the words of a slot share its probability by their counts
    total = np.bincount(ids[768:], np.exp(logs[768:] + np.where(known, 0, np.log(n))[768:]))
    assert total[total > 0] == pytest.approx(1)


def test_places_grow_with_the_corpus():
    assert [places(10 ** k) for k in (0, 4, 6, 8, 10)] == [1024, 1024, 1024, 8192, 131072]


@pytest.mark.parametrize("known", (0, 30, 1000))
def test_scores_word_by_word(spark, monkeypatch, known):
    """The same scores as a plain loop over words: window sum, tanh, class, place, and for a
    word without a place of its own its share of the slot."""
    monkeypatch.setattr(bidi_lm, "LEAST_PLACES", 16)
    monkeypatch.setattr(bidi_lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(bidi_lm, "KNOWN_COUNTS", known)
    trained = []
    train = bidi_lm.train
    monkeypatch.setattr(bidi_lm, "train", lambda *a: trained.append((train(*a), a[1])) or trained[0][0])
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(60))))
            for i in range(120)] + [(120, "twice only once"), (121, "twice"), (121, "twice"), (None, "W1 w2"), (122, None)]
    found = pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    (net, share), = trained
    low = [(i, (t or "").lower().split()) for i, t in rows]
    count = {}
    for _, ws in low:
        for w in ws:
            count[w] = count.get(w, 0) + 1
    key = {w: int(word_hashes(pa.array([w]))[0].view(np.int64)[0]) for w in count}
    size = len(share)
    assert size == 16 and len(count) > 40
    top = sorted(count, key=lambda w: (-count[w], key[w]))[:12]
    place = {w: top.index(w) if w in top else 12 + (key[w] & 3) for w in count}
    rest = {}
    for w in count:
        if w not in top:
            rest[place[w]] = rest.get(place[w], 0) + count[w]

    def softmax(z):
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    def naive(ws):
        total = 0.0
        for i, w in enumerate(ws):
            h = net.bias.astype(float)
            for k, d in enumerate((-2, -1, 1, 2)):
                if 0 <= i + d < len(ws):
                    h = h + net.embed[k][place[ws[i + d]]]
            h = np.tanh(h)
            c, m = divmod(place[w], net.members)
            total += np.log(softmax(h @ net.to_class + net.class_bias)[c])
            total += np.log(softmax(h @ net.to_word[c] + net.word_bias[c])[m])
            if w not in top:
                total += np.log(count[w] / rest[place[w]])
        return total

    want = sorted((-1 if i is None else i, len(ws), round(naive(ws), 2)) for i, ws in low)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["log_likelihood"]) for r in found)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=0.02)
    by = {r["doc_id"]: r["log_likelihood"] for r in found}
    assert by[121] != by[120]


def naive_hash(word: bytes, plus: int = 0) -> int:
    """The polynomial of a word's bytes and its finaliser, in whole numbers."""
    h = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(word)) + plus
    h %= 1 << 64
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ h >> shift) * by % (1 << 64)
    return h ^ h >> 31


def test_toxicity_by_double_loop(spark, monkeypatch):
    """The same scores as the sum over all pairs of a document's known terms."""
    models, fit = [], FactorizationMachine.train
    monkeypatch.setattr(FactorizationMachine, "train", lambda *a: models.append(fit(*a)) or models[0])
    docs, truth = made(spark, 200)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(900, None), (901, ""), (902, "Slurs, slurish! prose-Slur"), (902, "x"), (903, rows[5][1] * 30)]
    known = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    found = score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    m, = models
    place = {int(t): k for k, t in enumerate(m.terms)}

    def naive(text):
        low = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in (text or "").encode().lower())
        terms = set()
        for w in low.split():
            terms.add(naive_hash(w) >> 32)
            terms |= {prefix(w, k) for k in toxicity.PREFIXES if len(w) > k}
        at = sorted(place[t] for t in terms if t in place)
        z = m.bias + sum(m.linear[i] * m.evidence[i] for i in at)
        for a, i in enumerate(at):
            for j in at[a + 1:]:
                z += (m.factors[i] @ m.factors[j]) * m.evidence[i] * m.evidence[j]
        return 1 / (1 + np.exp(-z))

    def prefix(w, k):
        return naive_hash(w[:k], k) >> 32

    want = sorted((i, naive(t)) for i, t in rows)
    got = sorted((r["doc_id"], r["score"]) for r in found)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-6)
    assert len({round(g[1], 3) for g in got}) > 5


def naive_features(text: str) -> list[float]:
    """Content features of one text, byte by byte and word by word."""
    data = (text or "").encode()
    low = data.lower()
    kinds = [0] * cotrain._N_KINDS
    for b in data:
        kinds[next((k for k, c in enumerate(cotrain._KINDS) if b in c),
                   len(cotrain._KINDS) + (b < 128))] += 1
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", low) if w]
    lines = [x for x in low.split(b"\n") if x]
    pairs = list(zip(words, words[1:]))
    distinct = lambda x: len(set(x)) / len(x) if x else 1.0
    return [*(np.sqrt(k / max(len(data), 1)) for k in kinds), np.log1p(len(data)), np.log1p(len(words)),
            len(data) / max(len(words), 1) / 10, distinct(words), distinct(pairs), distinct(lines),
            np.log1p(len(data) / max(len(lines), 1))]


def test_text_features_one_by_one():
    rng = random.Random(2)
    texts = ["", None, "One", "a a a a a a", "a b A B a b", "x\n\ny\nX\n", "\t \n", "Éa ÉA {1} <p>", "end"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(60)]
    got = text_features(pa.array(texts))
    assert got == pytest.approx(np.array([naive_features(t) for t in texts]), rel=1e-5, abs=1e-6)


def test_quality_by_hand(spark, edge, labels, monkeypatch):
    """Both views' probabilities and the calibrated sum, document by document."""
    models, fit = [], cotrain.train
    monkeypatch.setattr(cotrain, "train", lambda *a: models.append(fit(*a)) or models[0])
    found = score_quality(edge, labels).collect()
    m, = models
    meta = {}
    for r in edge.select("doc_id", "text", cotrain._metadata(*[edge[c] for c in ("source", "lang", "n_chars")])
                         .alias("z")).collect():
        x, z = np.array(naive_features(r["text"])), np.array(r["z"], float)
        t = [(v @ w + b) * slope + shift
             for v, (w, b), (slope, shift) in zip((x, z), m.views, m.scales)]
        meta.setdefault(r["doc_id"], []).append([1 / (1 + np.exp(-u)) for u in (*t, t[0] + t[1] - m.prior)])
    assert len(found) == sum(map(len, meta.values()))
    for r in found:
        got = [r["content_score"], r["metadata_score"], r["score"]]
        assert any(got == pytest.approx(want, abs=1e-3) for want in meta[r["doc_id"]])
