import hashlib
import re

import pytest

from chunkwise.llm.mixing import mix, source_targets, take_mix

from llm_fixtures import edge, empty  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(t):
    return len(WORD.findall(t or ""))


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, top=2):
    """Deal, cap, deal the excess again by weight, until nothing is left over."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if out[s] >= top * sizes[s]:
                left += out[s] - top * sizes[s]
                out[s] = top * sizes[s]
                open_.discard(s)
    return out


def test_edge_rows(edge):
    rows = edge.collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    want = targets(sizes)
    found = mix(edge).collect()
    assert sorted((f["doc_id"] is None, f["doc_id"] or 0, f["size"]) for f in found) == \
        sorted((r["doc_id"] is None, r["doc_id"] or 0, size(r["text"])) for r in rows)
    by_id = {r["doc_id"]: r["source"] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for f in found:
        s = by_id[f["doc_id"]]
        assert f["source_size"] == sizes[s] and f["target"] == pytest.approx(want[s])
        assert 0 <= f["taken"] <= 2 * f["size"]
        taken[s] += f["taken"]
    assert taken == {s: int(want[s] + 1e-6) for s in sizes}
    assert sorted(map(tuple, mix(edge.repartition(7)).collect()), key=repr) == \
        sorted(map(tuple, found), key=repr)


def test_rows_are_taken_in_key_order(spark):
    df = spark.range(500).selectExpr("id as doc_id", "repeat('w ', 1 + id % 7) as text",
                                     "if(id % 3 = 0, 'a', 'b') as source")
    found = sorted(mix(df, share=0.5).collect(),
                   key=lambda r: hashlib.md5(f"mix-1:{r['doc_id']}".encode()).hexdigest())
    for part in ("a", "b"):
        own = [f for f in found if (f["doc_id"] % 3 == 0) == (part == "a")]
        cut = [f["taken"] < f["size"] for f in own]
        assert cut == sorted(cut) and sum(0 < f["taken"] < f["size"] for f in own) <= 1


def test_targets_of_many_sources(spark):
    sizes = {f"s{i:02d}": (i * 37) % 50 for i in range(30)} | {None: 11}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    want = targets(sizes)
    for r in source_targets(df).collect():
        assert r["target"] == pytest.approx(want[r["source"]])


def test_take_mix_gives_the_taken_words(edge):
    out = take_mix(edge)
    assert out.columns == edge.columns
    taken = {}
    for f in mix(edge).collect():
        taken[f["doc_id"]] = taken.get(f["doc_id"], 0) + f["taken"]
    got = {}
    texts = {r["doc_id"]: r["text"] for r in edge.collect()}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + size(r["text"])
        assert texts[r["doc_id"]].startswith(r["text"])
    assert got == {i: n for i, n in taken.items() if n}


def test_empty(empty):
    assert mix(empty).count() == 0 and take_mix(empty).count() == 0
