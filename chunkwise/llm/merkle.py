"""Merkle manifest of a dataset by time-forward processing (operator 13).

Every row is a leaf.  The leaves of a tree stand in a total order; every ``fanout``
consecutive nodes become one node, until one is left, the subroot; the subroots, in the order
of their trees' names, become the root in the same way.

Time-forward processing evaluates such a graph in the order of node labels (level, place): a
node's digest is sent into a priority queue under its parent's label, and when that label
comes up, all its children's digests are delivered together.  The queue is external: a task
sweeps the subtree over one aligned block of at most ``SPAN`` nodes with a queue in memory,
and what it sends beyond its block goes to Spark, which sorts it by label (tree, block) into
the tasks of the next round.  So each round makes ``SPAN`` nodes one, no task ever gets more
than ``SPAN`` nodes, however large a tree is, and 50 billion leaves take three rounds.

The reversed sweep goes through the rounds backwards, labels descending: every node gets from
its parent the siblings on the parent's way to the root and sends them on to its children,
with each child's own siblings before them; the leaves thus get their whole proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.operators.positions import with_position

from .common import join_by_group, stored

FANOUT = 2
#: Nodes of a block: bounds what a task holds.
SPAN = 4096
#: One entry a level, from the leaf to the root: the digests of the siblings before and after.
PROOF = "array<struct<before:string,after:string>>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as the number of its UTF-8 bytes, a colon and its text, a
    null as ``-``, so that no two different rows are written alike."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t),
                                        F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and the siblings of its proof give."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one text, from the leaf to the root, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), "")


def _height(n: int, fanout: int) -> int:
    """Levels from ``n`` nodes to one."""
    h = 0
    while n > 1:
        n, h = -(-n // fanout), h + 1
    return h


def _levels(fanout: int, span: int) -> int:
    h = 1
    while fanout ** (h + 1) <= span:
        h += 1
    return h


def forward(digests: Sequence[str], height: int, fanout: int) -> list[list[str]]:
    """The digests of every level over a block's nodes, ``height`` levels up."""
    levels = [list(digests)] + [[] for _ in range(height)]
    queue = [((1, i // fanout), i, d) for i, d in enumerate(digests)]   # in order: a heap
    while queue and queue[0][0][0] <= height:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heappop(queue)[2])
        digest = hashlib.sha256("".join(children).encode()).hexdigest()
        levels[label[0]].append(digest)
        heappush(queue, ((label[0] + 1, label[1] // fanout), label[1], digest))
    return levels


def backward(levels: list[list[str]], fanout: int, suffix) -> list:
    """What each of a block's nodes gets: its siblings, then its parent's, and so on, as a
    chain ((before, after), rest) that ends in the block's own ``suffix``."""
    out, queue = [], [(1 - len(levels), 0, suffix)]     # labels descending, negated
    while queue:
        level, place, chain = heappop(queue)
        if level == 0:
            out.append(chain)
            continue
        below = levels[-level - 1]
        first = -place * fanout
        run = below[first:first + fanout]
        for k in range(len(run)):
            heappush(queue, (level + 1, -(first + k),
                             (("".join(run[:k]), "".join(run[k + 1:])), chain)))
    return out[::-1]


def _flat(chain) -> list:
    out = []
    while chain is not None:
        out.append(chain[0])
        chain = chain[1]
    return out


def _steps(lists: list[list]) -> pa.Array:
    offs = [0]
    for x in lists:
        offs.append(offs[-1] + len(x))
    flat = [p for x in lists for p in x]
    pairs = pa.StructArray.from_arrays([pa.array([p[0] for p in flat], pa.string()),
                                        pa.array([p[1] for p in flat], pa.string())],
                                       ["before", "after"])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pairs).cast(pa.list_(_STEP))


def _chain(steps: list[dict]):
    chain = None
    for p in reversed(steps):
        chain = ((p["before"], p["after"]), chain)
    return chain


def _blocks(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(span)).cast("long"))


def _climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One round up over (tree, pos, n, digest): every block's top node, ``n`` being the
    nodes its tree has then."""
    span = fanout ** levels

    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        n = block["n"][0].as_py()
        top = forward(block["digest"].to_pylist(), min(levels, _height(n, fanout)), fanout)[-1]
        return pa.table({"tree": [key[0].as_py()], "pos": [key[1].as_py()],
                         "n": [-(-n // span)], "digest": top},
                        schema=pa.schema([("tree", pa.string()), ("pos", pa.int64()),
                                          ("n", pa.int64()), ("digest", pa.string())]))

    return (_blocks(nodes, span).groupBy("tree", "block")
            .applyInArrow(run, "tree string, pos bigint, n bigint, digest string"))


def _descend(nodes: DataFrame, above: DataFrame, fanout: int, levels: int,
             carry: Sequence[str] = ()) -> DataFrame:
    """The reversed round: ``above`` (tree, block, subroot, proof) of the blocks' top nodes
    gives (tree, pos, digest, subroot, proof) of the nodes, and their ``carry`` columns."""
    fields = [f for f in nodes.schema.fields if f.name in ("tree", "pos", "digest", *carry)]
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
              + f", subroot string, proof {PROOF}")

    def run(key: tuple, block: pa.Table, top: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        out, chains = block.select([f.name for f in fields]), []
        if len(block):                      # else a tree of one node, which is not in this round
            height = min(levels, _height(block["n"][0].as_py(), fanout))
            up = forward(block["digest"].to_pylist(), height, fanout)
            chains = backward(up, fanout, _chain(top["proof"][0].as_py()))
        out = out.append_column("subroot", pa.array(top["subroot"].to_pylist()[:1] * len(out), pa.string()))
        return out.append_column("proof", _steps([_flat(c) for c in chains]))

    return (_blocks(nodes, fanout ** levels).groupBy("tree", "block")
            .cogroup(above.groupBy("tree", "block")).applyInArrow(run, schema))


def _rounds(nodes: DataFrame, most: int, fanout: int, levels: int) -> list[DataFrame]:
    """The nodes at the bottom of each round and, last, the roots of all trees.  Trees that
    have come to one node wait as they are."""
    out = [nodes]
    while most > 1:
        last = out[-1]
        up = stored(_climb(last.filter("n > 1"), fanout, levels)
                    .unionByName(last.filter("n = 1").select("tree", "pos", "n", "digest")),
                    "merkle-nodes")
        out.append(up)
        most = -(-most // fanout ** levels)
    return out


def _back(rounds: list[DataFrame], proofs: DataFrame, fanout: int, levels: int,
          carry: Sequence[str] = ()) -> DataFrame:
    """From (tree, subroot, proof) of the trees' roots down to the first round's nodes."""
    known = proofs.withColumn("block", F.lit(0).cast("long"))
    for k, nodes in reversed(list(enumerate(rounds[:-1]))):
        cols = carry if k == 0 else ()
        lower = _descend(nodes.filter("n > 1"), known, fanout, levels, cols)
        # trees of one node already: what came from above is theirs
        lone = (nodes.filter("n = 1").join(known.drop("block"), "tree")
                .select("tree", "pos", "digest", *cols, "subroot", "proof"))
        lower = lower.select(*lone.columns).unionByName(lone)
        known = lower if k == 0 else stored(lower.select(
            "tree", F.col("pos").alias("block"), "subroot", "proof"), "merkle-proofs")
    if len(rounds) == 1:
        known = (rounds[0].join(known.drop("block"), "tree")
                 .select("tree", "pos", "digest", *carry, "subroot", "proof"))
    return known


def manifest(leaves: DataFrame, id_col: str = "doc_id", tree_col: str = "lang",
             leaf_col: str = "leaf", carry: Sequence[str] = (), fanout: int = FANOUT,
             span: int = SPAN) -> DataFrame:
    """(id, tree, pos, leaf, subroot, root, proof, carry...) of every row of ``leaves``.

    Per tree (null: a tree of its own, the first), leaves ascend by id (BIGINT, null first),
    rows of one id by digest, so repeated rows stand side by side and may change places
    without changing any digest.  While a tree has several nodes, every ``fanout``
    consecutive ones, at the end fewer and even one, become one whose digest is the SHA-256
    of their digests (hex) joined; a lone leaf is its tree's subroot.  The subroots in the
    order of the trees (UTF-8 bytes) become the root likewise.  ``proof`` holds, a level an
    entry, the siblings before and after (``fold`` gives the root, ``siblings`` the text).
    An empty table gives an empty result.  ``leaf_col`` must not be null; columns not named
    are ignored, so extra ones can't clash.
    """
    levels = _levels(fanout, span)
    names = [f"carry{k}" for k in range(len(carry))]
    rows = leaves.select(F.col(id_col).cast("long").alias("id"),
                         # never null, in the trees' order
                         F.coalesce(F.concat(F.lit("1"), F.col(tree_col).cast("string")),
                                    F.lit("0")).alias("tree"),
                         F.col(leaf_col).alias("digest"),
                         *[F.col(c).alias(n) for c, n in zip(carry, names)])
    rows = stored(rows, "merkle-leaves")
    placed = stored(with_position(rows, ["tree", F.col("id").asc_nulls_first(), "digest"], "at"),
                    "merkle-placed")
    trees = stored(placed.groupBy("tree").agg(F.min("at").alias("start"),
                                              F.count(F.lit(1)).alias("n")), "merkle-trees")
    n_rows, most, n_trees = trees.agg(F.sum("n"), F.max("n"), F.count(F.lit(1))).first()
    if not n_rows:
        most = n_trees = n_rows = 0
    nodes = stored(join_by_group(placed, trees, "tree", "n", n_rows)
                   .select("tree", (F.col("at") - F.col("start")).alias("pos"), "n", "digest", "id",
                           *names), "merkle-nodes")
    rounds = _rounds(nodes, most, fanout, levels)
    # the tree over the trees
    tops = with_position(rounds[-1].select("tree", "digest"), ["tree"])
    tops = stored(tops.select(F.lit("").alias("tree"), "pos", F.lit(n_trees).cast("long").alias("n"),
                              "digest", F.col("tree").alias("name")), "merkle-tops")
    over = _rounds(tops, n_trees, fanout, levels)
    root = over[-1].select(F.col("digest").alias("root"))
    none = F.lit([]).cast(PROOF)
    subroots = _back(over, over[-1].select("tree", F.col("digest").alias("subroot"),
                                           none.alias("proof")), fanout, levels, ("name",))
    subroots = stored(subroots.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"),
                                      "proof"), "merkle-subroots")
    out = _back(rounds, subroots, fanout, levels, ("id", *names))
    return out.crossJoin(F.broadcast(root)).select(
        F.col("id").alias(id_col),
        F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30)).alias("tree"), "pos",
        F.col("digest").alias("leaf"), "subroot", "root", "proof",
        *[F.col(n).alias(c) for c, n in zip(carry, names)])
