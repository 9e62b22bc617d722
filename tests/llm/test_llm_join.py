import hashlib
import random
import re

import pytest

from chunkwise.llm.components import components
from chunkwise.llm.group_join import drop_near_copies, near_components, shingle_sets

from llm_fixtures import edge, empty  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))


def brute(rows, percent=85, width=4):
    """(id, set size, least id, number of the component) of each row by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return [(rows[i][0], len(sets[i]), least.get(top(i)), top(i)) for i in range(len(rows))]


def ordered(rows):
    return sorted(rows, key=repr)


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [tuple(r) for r in near_components(df).collect()]
    assert ordered(got) == ordered(r[:3] for r in brute(rows))


def keepers(rows, percent=85, width=4):
    """The rows that stay, by id and text."""
    groups, out = {}, []
    for (i, text), (_, n, _, c) in zip(rows, brute(rows, percent, width)):
        if n:
            groups.setdefault(c, []).append((i is None, i or 0, hashlib.md5(text.encode()).hexdigest(), i, text))
        else:
            out.append((i, text))
    return ordered(out + [min(g)[3:] for g in groups.values()])


def test_edge_rows(edge):
    check(edge)


def test_null_and_repeated_ids(spark):
    """An unrelated text under the id of a near copy, near copies under one id and without
    ids, identical rows, and components of rows without ids only."""
    rng = random.Random(5)
    text = lambda name, n=60: [f"{name}{k}" for k in range(n)]
    swap = lambda words, k: [*words[:k], "other", *words[k + 1:]]
    a, b, c = text("a"), text("b"), text("c")
    rows = [(1, a), (5, swap(a, 0)), (5, text("clean")), (None, swap(a, 59)), (None, text("alone")),
            (None, b), (None, swap(b, 0)), (7, c), (7, swap(c, 0)), (7, swap(c, 59)), (7, c), (7, text("more")),
            (8, text("twice")), (8, text("twice")), (9, text("twice")), (None, None), (3, None), (3, None)]
    rows = [(i, t and " ".join(t)) for i, t in rows]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(df)
    want = keepers([r for r in rows if r[1] is not None]) + [r for r in rows if r[1] is None]
    assert ordered(tuple(r) for r in drop_near_copies(df).collect()) == ordered(want)


def test_chains_and_crowds(spark):
    """Near copies of one text, chains of them, and a passage that all rows share."""
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in range(i % 5):
            words[(7 * i + 11 * k) % 80] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    for i in range(25):  # a chain: each loses a word at the front and gains one at the back
        rows.append((100 + i, " ".join(f"c{k}" for k in range(i, i + 60))))
    for i in range(40):  # mostly a common passage, with own words
        own = [f"o{i}n{k}" for k in range(6 + i % 9)]
        rows.append((200 + i, " ".join([*own, *base[:50]])))
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))


def test_sets_with_equal_prefixes(spark):
    """Sets that differ only in shingles all rows hold have one prefix: they form a group."""
    rows = []
    for i in range(30):
        words = [f"r{i // 10}q{k}" for k in range(12)] + [f"t{k}" for k in range(40)]
        if i % 10:
            words = words[:12] + words[12 + i % 3:] + [f"t{k}" for k in range(i % 10)]
        rows.append((i, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_drop_near_copies(edge):
    kept = drop_near_copies(edge)
    assert kept.columns == edge.columns
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = keepers([r for r in rows if r[1] is not None]) + [r for r in rows if r[1] is None]
    assert ordered((r["doc_id"], r["text"]) for r in kept.collect()) == ordered(want)


def test_empty(empty):
    assert near_components(empty).count() == 0 and drop_near_copies(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 250)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 250: 200, 300: 200}


@pytest.mark.parametrize("text,n", [("", 0), ("a", 1), ("a b c", 1), ("a b c d", 1), ("a a a a a a", 1), ("a b c d e", 2)])
def test_shingle_counts(text, n):
    import pyarrow as pa
    assert [len(s) for s in shingle_sets(pa.array([text, None, "A  b\tC d"]))] == [n, 0, 1]


def test_workers_get_batches_of_bounded_bytes(spark):
    import pyarrow as pa

    from chunkwise.llm import common

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["size"])

    common.ship(spark)
    docs = spark.range(1200).coalesce(1).selectExpr("id doc_id", "repeat('some words ', 1000) text")
    sizes = [r["size"] for r in docs.mapInArrow(size, "size bigint").collect()]
    assert sum(sizes) > 3 * common.BATCH_BYTES and max(sizes) < 1.1 * common.BATCH_BYTES
    before = spark.conf.get(common._BATCH_CONF)
    try:
        spark.conf.set(common._BATCH_CONF, "12345678")
        common.ship(spark)
        assert spark.conf.get(common._BATCH_CONF) == "12345678"
    finally:
        spark.conf.set(common._BATCH_CONF, before)
