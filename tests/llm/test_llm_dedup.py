import hashlib
from collections import defaultdict

from chunkwise.llm.bloom_dedup import drop_copies, exact_groups

from llm_fixtures import edge, empty  # noqa: F401

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["text"] or "").translate(UPPER)].append(r["doc_id"])
    return groups


def check(rows, found):
    groups = brute(rows)
    assert len(found) == len(rows)
    of = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for f in found:
        ids = of[f["text_sha256"]]
        assert f["doc_id"] in ids
        assert f["group_size"] == len(ids)
        assert f["keep_id"] == max(ids, key=lambda i: (i is not None, i))
        if f["kept"]:
            assert f["doc_id"] == f["keep_id"]
            kept[f["text_sha256"]] += 1
    assert dict(kept) == {t: 1 for t in of}


def test_edge_rows(edge):
    rows = edge.collect()
    check(rows, exact_groups(edge).collect())


def test_shards_give_the_same_rows(edge):
    """A filter too small for all rows is built shard by shard."""
    check(edge.collect(), exact_groups(edge, filter_bits=256).collect())


def test_hot_group(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Same', concat('t', id)) as text")
    check(df.collect(), exact_groups(df).collect())


def test_empty(empty):
    assert exact_groups(empty).count() == 0
    assert drop_copies(empty).columns == empty.columns and drop_copies(empty).count() == 0


def test_drop_copies_keeps_the_largest_id(edge):
    kept = drop_copies(edge)
    assert kept.columns == edge.columns
    got = sorted(((r["text"] or "").translate(UPPER), r["doc_id"]) for r in kept.collect())
    want = sorted((t, max(ids, key=lambda i: (i is not None, i or 0)))
                  for t, ids in brute(edge.collect()).items())
    assert got == want
