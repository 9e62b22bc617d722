"""N-gram Jaccard join with grouped prefixes (operator 9).

Two sets with Jaccard similarity t or more share one of their first n - ceil(t n) + 1
shingles in any common order of all shingles.  The order is rare ones first, by a counting
sketch over all documents (its size is fixed; a wrong estimate costs time, never a link).

1. Documents with equal sets form a class; one row of it goes on.
2. Classes with the same prefix and size form a group; only groups enter the index of
   prefix shingles.  Shingles of one group only are left out.
3. Stars: each group is compared with the most central group of each of its shingles, and
   each member of a group with the group's first.  Their links give first components.
4. Whatever pairs of different components remain among the groups of a shingle are filtered
   by size, by position, and by their distances to the common centre (Jaccard distance is
   a metric), then expanded to members and verified.  So every link between components is
   found, while a group of near copies costs about one comparison per member.

Group pairs are filtered by size, by position and by the overlap of their whole prefixes;
shingle sets are read again only for the documents of the pairs that remain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BLOCKS, HashFilter, array_blocks, fresh, id_text, join_by_group, mix64, slices,
                     stored, sum_arrays, word_hashes)
from .components import components

WIDTH = 4
PERCENT = 85
#: Cells of the counting sketch (4 bytes each), sent to the tasks.
CELLS = 1 << 18
#: Bytes of text whose words are hashed at once: the arrays for it are up to 50 times as large.
SLICE_BYTES = 1 << 18
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(values: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 62-bit hashes; a text of fewer words
    has its whole sequence as one, a text without words none."""
    words, counts = word_hashes(values)
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        run = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width):
            run = run * _STEP + words[k:len(words) - width + 1 + k]
        run = (mix64(run) >> np.uint64(2)).astype(np.int64)
        out = []
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if b - a >= width:
                out.append(np.unique(run[a:b - width + 1]))
            else:
                h = np.zeros(int(b > a), np.uint64)
                for w in words[a:b]:
                    h = h * _STEP + w
                out.append((mix64(h + np.uint64(b - a)) >> np.uint64(2)).astype(np.int64))
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Number of documents by cell of a shingle's hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, any_rows = np.zeros(CELLS), False
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                for s in shingle_sets(batch.column(1).slice(a, b - a), width):
                    any_rows = True
                    np.add.at(cells, s & (CELLS - 1), 1)
        if any_rows:
            yield array_blocks(cells)

    return sum_arrays(docs.mapInArrow(count, BLOCKS), CELLS)


def _prefixes(docs: DataFrame, cells: np.ndarray, width: int, percent: int) -> DataFrame:
    """(doc_id, txt, n, cls, grp, prefix): digest of the text, set size, digests of the set
    and of prefix and size, and the prefix in the common order."""
    counts = docs.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = counts.value
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                rows = batch.slice(a, b - a)
                sets, heads, cls, grp = shingle_sets(rows.column(1), width), [], [], []
                for s in sets:
                    n = len(s)
                    take = n - (percent * n + 99) // 100 + 1 if n else 0
                    order = np.argsort(cells[s & (CELLS - 1)], kind="stable")[:take]
                    heads.append(s[order])
                    cls.append(_digest(s))
                    grp.append(hashlib.blake2b(s[order].tobytes() + n.to_bytes(8, "little"),
                                               digest_size=16).digest())
                offs = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(cls, pa.binary()), pa.array(grp, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(heads)))],
                    ["doc_id", "txt", "n", "cls", "grp", "prefix"])

    return docs.mapInArrow(run, "doc_id bigint, txt string, n bigint, cls binary, grp binary, "
                                "prefix array<bigint>")


def _sets_of(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """(rep, shingles): the sets of the classes in ``reps`` (rep, doc_id, cls), read from
    the texts of the documents with these ids.  The filter of ids is tested in the same
    function that makes the sets, so a task needs one Python worker; a document of the same
    id and another set goes in the join by the set's digest."""
    wanted = HashFilter.build(reps.select(F.xxhash64("doc_id").alias("h")).distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.test(batch.column(2).to_numpy())))
            for a, b in slices(batch.column(1), SLICE_BYTES):
                sets = [s for s in shingle_sets(batch.column(1).slice(a, b - a), width) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "shingles"])

    found = (docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
             .mapInArrow(run, "cls binary, shingles binary"))
    return found.join(reps.select("rep", "cls"), "cls").select("rep", "shingles").dropDuplicates(["rep"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two arrays of distinct values, the second one sorted."""
    if not len(x) or not len(y):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _may_link(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The group pairs (ga, gb) that their prefixes allow to link: of the one whose prefix
    ends first in the common order, all shared shingles are in both prefixes or after its
    own, so the overlap is at most the prefixes' overlap and the longer rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, na, nb in zip(batch.column("pa"), batch.column("pb"),
                                    batch.column("na").to_pylist(), batch.column("nb").to_pylist()):
                x, y = x.values.to_numpy(), np.sort(y.values.to_numpy())
                most = _common(x, y) + max(na - len(x), nb - len(y))
                keep.append((100 + percent) * most >= percent * (na + nb))
            yield batch.select(["ga", "gb"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: groups.select(F.col("gid").alias(f"g{s}"), F.col("n").alias(f"n{s}"),
                                   F.col("prefix").alias(f"p{s}"))
    return (pairs.join(side("a"), "ga").join(side("b"), "gb")
            .select("ga", "gb", "na", "nb", "pa", "pb").mapInArrow(run, "ga bigint, gb bigint"))


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(a, b, na, nb, common) of the pairs (a, b) of classes, whose texts are read for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x = np.frombuffer(x.as_buffer(), np.int64)
                y = np.frombuffer(y.as_buffer(), np.int64)
                sizes.append((len(x), len(y), _common(x, y)))
            na, nb, common = zip(*sizes) if sizes else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(na, pa.int64()),
                 pa.array(nb, pa.int64()), pa.array(common, pa.int64())],
                ["a", "b", "na", "nb", "common"])

    pairs = stored(pairs, "join-pairs")
    reps = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    reps = stored(reps.join(classes.select("rep", "doc_id", "cls"), "rep"), "join-reps")
    sets = stored(_sets_of(docs, reps, width), "join-sets")
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(
        run, "a bigint, b bigint, na bigint, nb bigint, common bigint")


def _sizes_fit(n, m, percent: int):
    """Sets of such different sizes can't be similar enough."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _classes_of(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their text's digest; the prefixes of their sets; and the classes of equal
    sets (cls, rep, doc_id, copies, grp).  ``rep`` numbers the classes: links are between
    classes, so ids may be missing or repeated; ``doc_id`` (the least) only helps to find a
    text of the class again."""
    rows = id_text(docs, id_col, text_col).withColumn("txt", F.md5(F.col("text").cast("binary")))
    heads = stored(_prefixes(rows, _sketch(rows, width), width, percent), "join-prefixes")
    classes = heads.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("grp").alias("grp"))
    # numbered in the write: what is read back never changes
    return rows, heads, stored(classes.withColumn("rep", F.monotonically_increasing_id()),
                               "join-classes")


def _links(rows: DataFrame, heads: DataFrame, classes: DataFrame, width: int, percent: int
           ) -> DataFrame:
    """(node, component) of the classes that link with others."""
    some = heads.filter("n > 0")
    heads_of = some.groupBy("grp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = stored(classes.groupBy("grp").agg(F.min("rep").alias("gid"),
                                               F.count(F.lit(1)).alias("members"))
                    .join(heads_of, "grp"), "join-groups")

    # the index: shingles that are in the prefixes of two groups or more
    shared = stored(groups.select(F.explode("prefix").alias("token")).groupBy("token")
                    .agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "join-tokens")
    maybe = HashFilter.build(shared.select("token"))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            offs, token = prefix.offsets.to_numpy(), prefix.values.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(offs))
            pos = np.arange(offs[0], offs[-1]) - offs[row]
            token = token[offs[0]:offs[-1]]
            keep = maybe.test(token)
            row = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[keep]), batch.column("gid").take(row), batch.column("n").take(row),
                 pa.array(pos[keep])], ["token", "gid", "n", "pos"])

    index = stored(groups.select("gid", "n", "prefix")
                   .mapInArrow(postings, "token bigint, gid bigint, n bigint, pos bigint")
                   .join(shared, "token"), "join-index")

    # stars around the group of each shingle that shares most with others
    weight = index.groupBy("gid").agg(F.sum(F.log2("df")).alias("weight"))
    centre = (index.join(weight, "gid").groupBy("token")
              .agg(F.max_by("gid", F.struct("weight", -F.col("gid"))).alias("centre")))
    index = stored(index.join(centre, "token"), "join-index")
    member = classes.select("grp", "rep").join(groups.select("grp", "gid", "members"), "grp")
    member = stored(member.select("rep", "gid", "members"), "join-members")
    middle = groups.select(F.col("gid").alias("centre"), F.col("n").alias("m"))
    place = index.filter("gid = centre").select("token", F.col("pos").alias("place"))
    room = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("place"))
    stars = (index.filter("gid <> centre").join(place, "token").join(middle, "centre")
             .filter(_sizes_fit(F.col("n"), F.col("m"), percent)
                     & ((100 + percent) * room >= percent * (F.col("n") + F.col("m"))))
             .select(F.least("gid", "centre").alias("ga"), F.greatest("gid", "centre").alias("gb"))
             .distinct())
    stars = (_may_link(stars, groups, percent).select(F.col("ga").alias("a"), F.col("gb").alias("b"))
             .unionByName(member.filter("rep <> gid").select(F.col("gid").alias("a"),
                                                             F.col("rep").alias("b"))))
    alike = F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb")
                                                              - F.col("common"))
    near = stored(_verify(stars, rows, classes, width), "join-stars")
    links = near.filter(alike).select("a", "b")
    first = components(links)

    # what is left: groups of a shingle that are in different components
    label = (member.join(first.withColumnRenamed("node", "rep"), "rep", "left")
             .select("rep", "gid", F.coalesce("component", "rep").alias("component")))
    label = stored(label, "join-labels")
    whole = label.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count(F.lit(1)).alias("members"))
    distance = near.select(F.col("a").alias("x"), F.col("b").alias("y"),
                           (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common")))
                           .alias("far"))
    distance = (distance.unionByName(distance.select(F.col("y").alias("x"), F.col("x").alias("y"), "far"))
                .dropDuplicates(["x", "y"]))
    marked = (index.join(whole, "gid")
              .join(distance, (F.col("gid") == F.col("x")) & (F.col("centre") == F.col("y")), "left")
              .select("token", "gid", "n", "pos", "centre", "lo", "hi",
                      # the distance is the first member's: it holds for groups of one
                      F.when(F.col("members") == 1, F.when(F.col("gid") == F.col("centre"), F.lit(0.0))
                             .otherwise(F.col("far"))).alias("far")))
    marked = stored(marked, "join-marked")
    main = (marked.filter("lo = hi").groupBy("token", "lo").count()
            .groupBy("token").agg(F.max_by("lo", F.struct("count", "lo")).alias("main")))
    slack = F.lit(1 - percent / 100 + 1e-9)
    # beyond the centre's component and its surroundings, only groups outside a shingle's
    # main component need partners; a partner is at most one size class away
    size_class = F.floor(F.log("n") / F.lit(-float(np.log(percent / 100)))).alias("size")
    probe = (marked.join(main, "token", "left")
             .filter("main is null or lo <> hi or lo <> main")
             .select("token", "gid", "n", "pos", "lo", "hi", "far",
                     F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)),
                                           lambda d: size_class + d)).alias("size")))
    other = marked.select("token", "n", "pos", "lo", "hi", "far", "gid", size_class)
    p, o = probe.alias("p"), other.alias("o")
    room = F.least(F.col("p.n") - F.col("p.pos"), F.col("o.n") - F.col("o.pos"))
    rest = (p.join(o, (F.col("p.token") == F.col("o.token")) & (F.col("p.size") == F.col("o.size"))
                   & (F.col("p.gid") != F.col("o.gid"))
                   & ((F.col("p.lo") != F.col("o.lo")) | (F.col("p.lo") != F.col("p.hi"))
                      | (F.col("o.lo") != F.col("o.hi")))
                   & _sizes_fit(F.col("p.n"), F.col("o.n"), percent)
                   & ((100 + percent) * room >= percent * (F.col("p.n") + F.col("o.n")))
                   & (F.coalesce(F.abs(F.col("p.far") - F.col("o.far")), F.lit(0.0)) <= slack))
            .select(F.least("p.gid", "o.gid").alias("ga"), F.greatest("p.gid", "o.gid").alias("gb"))
            .unionByName(whole.filter("lo <> hi").select(F.col("gid").alias("ga"),
                                                         F.col("gid").alias("gb"))).distinct())
    rest = _may_link(rest, groups, percent)
    side = lambda s: label.select(F.col("gid").alias(f"g{s}"), F.col("rep").alias(s),
                                  F.col("component").alias(f"c{s}"))
    pairs = (rest.join(side("a"), "ga").join(side("b"), "gb").filter("ca <> cb and a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = stored(_verify(pairs, rows, classes, width).filter(alike).select("a", "b"), "join-more")
    return components(links.unionByName(more))


def _found(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(doc_id, txt, n, component, component_id) of every row; null components: no shingles."""
    rows, heads, classes = _classes_of(docs, id_col, text_col, width, percent)
    n_rows = heads.count()
    final = _links(rows, heads, classes, width, percent)
    found = stored(classes.join(final.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("cls", "doc_id", "copies", F.coalesce("component", "rep").alias("component")),
                   "join-found")
    names = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = stored(found.drop("doc_id").join(names, "component"), "join-components")
    return (join_by_group(heads.filter("n > 0").select("doc_id", "txt", "n", "cls"), found, "cls",
                          "copies", n_rows)
            .select("doc_id", "txt", "n", "component", "component_id")
            .unionByName(heads.filter("n = 0").select(
                "doc_id", "txt", "n", F.lit(None).cast("long").alias("component"),
                F.col("doc_id").alias("component_id"))))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Words are runs of characters other than blanks, A-Z lower-cased; a document's set is
    its distinct shingles of ``width`` words.  Documents link when 100 * intersection >=
    percent * union; component_id is the smallest doc_id that links lead to, itself
    included.  Null and empty texts have no shingles and link with nothing; repeated rows
    link with each other.  Rows of one id with different texts are different documents, and
    so are rows without id, which are linked like others: a component_id is null where no
    row of the component has an id.  Other columns are ignored.
    """
    return _found(docs, id_col, text_col, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id (rows
    without id last; of one id, the smallest digest of the text; of rows equal in both, any
    one).  Rows are told apart by id and text together, so an id that several texts share
    drops none but the copies; texts without shingles all stay.  Only rows that the filter
    of dropped rows can't clear are compared with them."""
    found = stored(_found(docs, id_col, text_col, width, percent).filter("component is not null")
                   .select("doc_id", "txt", "component"), "near-found")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "txt")
    first = found.groupBy("component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    joined = join_by_group(found, first, "component", "copies", found.count())
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("txt") == F.col("first.txt"))
    marked = (joined.filter("copies > 1").select("doc_id", "txt", same.alias("stays"))
              .groupBy("doc_id", "txt").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("rows")))
    # what goes, and keys that stay but have several rows
    gone = stored(marked.filter("not stays or rows > 1"), "near-dropped")
    maybe = HashFilter.build(gone.select(F.xxhash64("doc_id", "txt").alias("h")))
    names = docs.columns
    key, txt, flag = (fresh(c, names) for c in ("_id", "_txt", "_maybe"))
    rows = docs.withColumns({key: F.col(id_col).cast("long"), txt: F.md5(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))})
    rows = rows.withColumn(flag, maybe.maybe(F.xxhash64(key, txt)))
    cols = [F.col(f"`{c}`") for c in names]
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("txt").alias("_gone_txt"), "stays")
    told = (rows.filter(flag).select(F.struct(*cols).alias("_row"), F.col(key).alias("_k"), F.col(txt).alias("_t"))
            .join(gone, (F.col("_t") == F.col("_gone_txt")) & F.col("_k").eqNullSafe(F.col("_gone_id")), "left"))
    clear = told.filter("stays is null").select("_row.*")
    one = told.filter("stays").dropDuplicates(["_k", "_t"]).select("_row.*")
    return rows.filter(~F.col(flag)).select(*cols).unionByName(clear).unionByName(one)
