import math

import numpy as np
import pytest

from chunkwise.llm import lsh_forest
from chunkwise.llm.common import ship, table
from chunkwise.llm.lsh_forest import nearest

ASKED = "vec_id % 20 = 0"


def brute(rows, k=20):
    """Exact answer over the rows that take part."""
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and any(v)
                 and all(x is not None and math.isfinite(x) for x in v)})
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            scores = [(-float(np.dot(np.array(v), np.array(w))), j) for j, w in ok if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    assert set(got) == set(want)
    hit = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    return hit / sum(len(v) for v in want.values())


def test_recall_of_the_driver_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert recall(answers(nearest(df, ASKED)), brute(rows)) >= 0.9


def test_recall_with_deep_levels(spark, monkeypatch):
    """Clustered vectors of many lengths; few candidates, so the trees are really searched."""
    monkeypatch.setattr(lsh_forest, "LEAST", 16)
    monkeypatch.setattr(lsh_forest, "BLOCK_ROWS", 64)
    ship(spark)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 2000)] + 0.25 * rng.normal(size=(2000, 24))
    x *= rng.uniform(0.9, 1.1, (2000, 1))
    rows = [(i, [float(f) for f in np.float32(v)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = answers(nearest(df, ASKED)), brute(rows)
    assert recall(got, want) >= 0.9
    data = dict(rows)
    for q, hits in got.items():
        assert [s for _, s in hits] == sorted((s for _, s in hits), reverse=True)
        for j, s in hits:
            assert s == pytest.approx(float(np.dot(data[q], data[j])), rel=1e-12)


def test_edge_rows(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(45)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(100, 165)]  # ties, more than the answer holds
    rows += [(400, None), (420, [0.0] * 4), (440, [float("nan"), 1.0, 1.0, 1.0]),
             (460, [float("inf"), 1.0, 1.0, 1.0]), (480, [None, 1.0, 1.0, 1.0]), (500, [1.0, 2.0]),
             (None, [1.0] * 4), (20, rows[20][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, vec string, rank int")
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
                  for i, v in rows if v is None or len(v) == 4])
    got = answers(nearest(df, ASKED))
    assert set(got) == set(want)
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
    few = df.filter("vec_id < 7")
    assert {q: len(v) for q, v in answers(nearest(few, ASKED)).items()} == {0: 6}
    assert nearest(df.filter("vec_id < 0"), ASKED).count() == 0


@pytest.mark.parametrize("longest", [1.0, 60.0])
def test_queries_without_neighbours_in_the_trees(spark, monkeypatch, longest):
    """A dense cluster, queries that point away from it, and one vector that may be very long."""
    monkeypatch.setattr(lsh_forest, "LEAST", 16)
    monkeypatch.setattr(lsh_forest, "BLOCK_ROWS", 64)
    ship(spark)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    x = centre + 0.1 * rng.normal(size=(1500, 16))
    x[::100] = -centre + 0.5 * rng.normal(size=(15, 16))  # queries, as every twentieth row
    x[20::100] = 2 * rng.normal(size=(15, 16))
    x[7] *= longest
    rows = [(i, [float(f) for f in np.float32(v)]) for i, v in enumerate(x)]
    got = answers(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), ASKED))
    want = brute(rows)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
    assert recall(got, want) >= 0.9
    away = {q for q in want if q % 100 in (0, 20)}
    assert recall({q: got[q] for q in away}, {q: want[q] for q in away}) >= 0.9
