"""Operator 13 against a tree built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from chunkwise.llm import merkle
from chunkwise.llm.common import table
from chunkwise.llm.queries import QUERIES

from conftest import SF_CHECK
from llm_fixtures import CLASHING, edge, empty  # noqa: F401


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests: list[str], fanout: int) -> tuple[str, list[list[tuple]]]:
    """The one node left, and each leaf's [(before, after)] on the way to it."""
    proofs, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            first = i - i % fanout
            proofs[leaf].append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])))
        at = [i // fanout for i in at]
        nodes = [sha("".join(nodes[k:k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def brute(rows: list[tuple], fanout: int = 2) -> tuple[str, dict]:
    """root and {(tree, id, leaf): [(subroot, proof)]} of (id, tree, leaf) rows."""
    trees = {}
    for i, tree, leaf in rows:
        trees.setdefault(tree, []).append((i is not None, i or 0, leaf))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    subs = [climb([x[2] for x in sorted(trees[t])], fanout) for t in names]
    root, over = climb([s for s, _ in subs], fanout)
    out = {}
    for t, (sub, proofs), top in zip(names, subs, over):
        for (some, i, leaf), proof in zip(sorted(trees[t]), proofs):
            out.setdefault((t, i if some else None, leaf), []).append((sub, tuple(proof + top)))
    return root, out


def held(found) -> dict:
    out = {}
    for r in found.collect():
        out.setdefault((r["tree"], r["id"], r["leaf"]), []).append(
            (r["subroot"], tuple((p["before"], p["after"]) for p in r["proof"])))
    return out


@pytest.mark.parametrize("fanout,span", [(2, 4096), (2, 4), (3, 9), (2, 2)])
def test_every_size_of_tree(spark, fanout, span):
    """Trees of 1 to 40 leaves, and fewer and more blocks and rounds than one."""
    rows = [(k, f"t{size}", sha(f"{size}.{k}")) for size in (1, 2, 3, 4, 5, 8, 9, 17, 40) for k in range(size)]
    rows += [(7, None, sha("null tree")), (8, "", sha("empty name")), (None, "ä", sha("no id"))]
    df = spark.createDataFrame(rows, "id bigint, tree string, leaf string").repartition(3)
    found = merkle.manifest(df, "id", "tree", "leaf", fanout=fanout, span=span)
    root, want = brute(rows, fanout)
    assert {r["root"] for r in found.select("root").collect()} == {root}
    assert held(found) == want
    folded = found.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert all(r["ok"] for r in folded.collect())


def test_a_task_gets_one_block(spark):
    """Blocks are aligned and bounded, whatever a tree's size."""
    rows = spark.range(1000).select(F.col("id"), F.lit("t").alias("tree"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("digest"),
                                    F.col("id").alias("pos"), F.lit(1000).cast("long").alias("n"))
    sizes = [r["count"] for r in merkle._blocks(rows, 16).groupBy("tree", "block").count().collect()]
    assert max(sizes) == 16 and len(sizes) == 63
    up = merkle._climb(rows, 2, 4)
    assert up.count() == 63 and {r["n"] for r in up.collect()} == {63}


def test_query_against_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents").collect()
    rows = {r["doc_id"]: r for r in docs}
    leaf = lambda r, more=0: leaf_of(r["doc_id"], r["source"], r["lang"],                   # noqa: E731
                                     None if r["n_chars"] is None else r["n_chars"] + more, r["text"])
    root, want = brute([(r["doc_id"], r["lang"], leaf(r)) for r in docs])
    assert len(want) == len(docs)
    got = QUERIES["op13_merkle_manifest"](spark, SF_CHECK)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    seen = set()
    for r in got.collect():
        d = rows[r["doc_id"]]
        seen.add(r["doc_id"])
        [(sub, proof)] = want[d["lang"], r["doc_id"], leaf(d)]
        folded = leaf(d, int(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0))
        for before, after in proof:
            folded = sha(before + folded + after)
        assert tuple(r[1:]) == (leaf(d), sub, root, sha("".join(b + a for b, a in proof)), folded,
                                folded == root)
    assert seen == set(rows)


def test_edge_rows(spark, edge, empty):
    """Nulls in any column, repeated rows, clashing columns; an empty table has no rows."""
    digest = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    rows = edge.withColumn("leaf", digest)
    found = merkle.manifest(rows)
    data = edge.collect()
    want_root, want = brute([(r["doc_id"], r["lang"], leaf_of(*[r[c] for c in (
        "doc_id", "source", "lang", "n_chars", "text")])) for r in data])
    got = held(found.withColumnRenamed("doc_id", "id"))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert {r["root"] for r in found.collect()} == {want_root}
    assert merkle.manifest(empty.withColumn("leaf", digest)).collect() == []
    assert set(CLASHING) <= set(edge.columns)
