"""Near duplicates by a chosen-path similarity join over minwise tokens.

Every set of shingles (one class for all equal sets) has a fixed number of
minwise tokens; two sets agree in one with the probability of their similarity.
A tree branches a node by two of its tokens, selected by the node: a class goes
to one child for each of them, named by its value, so that a pair of similarity
s meets 2 s times on average in the next level and does not die out. Trees use
tokens of their own and are independent: at s = 0.8 a tree loses 4 % of the pairs
on its first level and 10 % by the sixth (measured), so four trees lose one pair
in 400,000 to one in 10,000, and fewer of those that are more similar.

Nodes are keys of a shuffle, a level is one job for all nodes of all trees. The
first level links the members of a node to its pivot, which connects whatever
is one group of copies; nodes of one component are done. Of the others those
with a bounded number of pairs between different components are compared
exhaustively, larger ones branch again: a first pass finds by a byte of each
token which members have a partner that the tokens do not rule out, a second one
has the whole sets of these and returns the links that join components. No pair
that does not link leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm import text as tx
from granero.llm.components import components
from granero.llm.jaccard import class_of, sets_of, shingle_sets
from granero.session import stage

SHINGLE = 4
PERCENT = 80  # least similarity of a link
TREES = 4
POOL = 16  # tokens of a tree, one is used up per level: the greatest depth
TOKENS = TREES * POOL
SKETCH = 128  # tokens that estimate a similarity, those of the trees and as many more, by their last byte
#: A pair of similarity 0.8 agrees in 102 of 128 tokens, give or take 4.5: in fewer than 82 once in 60,000 pairs.
AGREED = 82
#: A node is compared exhaustively when it has at most so many pairs between components, members, and shingles in all.
LEAF_PAIRS, LEAF_MEMBERS, LEAF_SHINGLES = 1 << 25, 1 << 14, 1 << 23
BLOCK = 256  # members of a block of a node that cannot branch any further

_U = np.uint64
_random = np.random.default_rng(80)
_XOR = _random.integers(0, 2**63, SKETCH, dtype=np.uint64)
_FACTOR = _random.integers(0, 2**62, SKETCH, dtype=np.uint64) * _U(2) + _U(1)
_SALT = _random.integers(0, 2**63, POOL, dtype=np.uint64)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 4096):
        part = shingles[low : low + 4096, None]
        np.minimum(least, ((part ^ _XOR) * _FACTOR).min(0), out=least)
    return (tx.mix(least) >> _U(32)).astype(np.uint32)


def _signed(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n, class, tokens (of the trees), sketch per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, tokens, sketches = [], [], [], []
            for _, shingles in shingle_sets(batch.column(2), k):
                sizes.append(len(shingles))
                classes.append(class_of(shingles) if len(shingles) else None)
                least = minwise(shingles) if len(shingles) else None
                tokens.append(None if least is None else least[:TOKENS].tobytes())
                sketches.append(None if least is None else least.astype(np.uint8).tobytes())
            columns = [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())]
            columns += [pa.array(tokens, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "class", "tokens", "sketch"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, class long, tokens binary, sketch binary")


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(len(column), width)


def _children(node: np.ndarray, path: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names and paths of the two children of each row's node that its tokens choose.

    ``path`` holds the tree above its lowest POOL bits and in these the tokens
    that led to the node; the node selects among the others.
    """
    order = tx.mix(node.view(np.uint64)[:, None] ^ _SALT) >> _U(1)
    order |= (path[:, None] >> np.arange(POOL) & 1).astype(np.uint64) << _U(63)
    chosen = np.argsort(order, axis=1)[:, :2]
    row, tree = np.arange(len(node)), path >> POOL
    for at in chosen.T:
        value = tokens[row, tree * POOL + at].astype(np.uint64)
        fresh = (path >> at & 1) == 0  # false only where all tokens but one are used up
        name = tx.mix(tx.mix(value << _U(8) | at.astype(np.uint64)) + node.view(np.uint64))
        yield np.where(fresh, name.view(np.int64), node), path | 1 << at


_MEMBER = "node long, path int, class long, n long"


def _branched(rows: DataFrame) -> DataFrame:
    """The children of (node, path, class, n, tokens): two rows for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, path = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            for name, way in _children(node, path, _matrix(batch.column(4), TOKENS, np.uint32)):
                columns = [pa.array(name), pa.array(way.astype(np.int32)), batch.column(2), batch.column(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "path", "class", "n"])

    return rows.select("node", "path", "class", "n", "tokens").mapInArrow(run, _MEMBER)


def _similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows agree in AGREED bytes at least; the 128 comparisons are added up eight at a time."""
    same = np.ascontiguousarray(a == b).view(np.uint64).sum(-1, dtype=np.uint64)
    return (same * _U(0x0101010101010101) >> _U(56)) >= AGREED


def _may_link(pairs: DataFrame) -> DataFrame:
    """Of (a, b, sketch_a, sketch_b) the pairs that agree in enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _similar(*[_matrix(batch.column(i), SKETCH, np.uint8) for i in (2, 3)])
                yield batch.select([0, 1]).filter(pa.array(near))

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _leaves(batches: Iterator[pa.RecordBatch], convert) -> Iterator[tuple[int, list]]:
    """Name and columns (joined from their pieces) of each leaf; rows come leaf by leaf, one leaf is held at a time."""
    current, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        leaf = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
        for low, high in zip(cuts, cuts[1:]):  # noqa: B905
            if leaf[low] != current:
                if held:
                    yield current, [np.concatenate(c) for c in zip(*held, strict=True)]
                current, held = leaf[low], []
            held.append(convert(batch.slice(low, high - low)))
    if held:
        yield current, [np.concatenate(c) for c in zip(*held, strict=True)]


def _open_partners(i: int, root: np.ndarray, block: np.ndarray, n: np.ndarray, sketch: np.ndarray, first: int) -> np.ndarray:
    """Members from ``first`` on that may link to member i and are not connected with it."""
    open_ = (root[first:] != root[i]) & (5 * np.minimum(n[first:], n[i]) >= 4 * np.maximum(n[first:], n[i]))
    open_ &= (block[first:] != block[i]) | (block[i] < 0)
    others = np.flatnonzero(open_) + first
    return others[_similar(sketch[others], sketch[i])] if len(others) else others


_LEAF = "leaf long, class long, root long, block long, n long"


def _with_partners(members: DataFrame) -> DataFrame:
    """Of (leaf, class, root, block, n, sketch) the rows with a partner in their leaf that they may link to."""

    def convert(part: pa.RecordBatch) -> list[np.ndarray]:
        return [c.to_numpy() for c in part.columns[1:5]] + [_matrix(part.column(5), SKETCH, np.uint8)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, (name, root, block, n, sketch) in _leaves(batches, convert):
            some = np.zeros(len(name), bool)
            for i in range(len(name) - 1):
                others = _open_partners(i, root, block, n, sketch, i + 1)
                some[others] = True
                some[i] |= len(others) > 0
            if some.any():
                columns = [np.full(int(some.sum()), leaf), *(c[some] for c in (name, root, block, n))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["leaf", "class", "root", "block", "n"])

    ordered = members.repartition("leaf").sortWithinPartitions("leaf")
    return ordered.select("leaf", "class", "root", "block", "n", "sketch").mapInArrow(run, _LEAF)


def _leaf_links(members: DataFrame) -> DataFrame:
    """a, b: the links that join the components (a, b: their roots) of each leaf, from (leaf, class, root, block, n, sketch, shingles)."""

    def convert(part: pa.RecordBatch) -> list[np.ndarray]:
        return [
            *(c.to_numpy() for c in part.columns[2:5]),
            _matrix(part.column(5), SKETCH, np.uint8),
            part.column(6).flatten().to_numpy().view(np.uint64),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (root, block, n, sketch, shingles) in _leaves(batches, convert):
            starts, joined, found = np.cumsum(n) - n, root.copy(), []
            for i in range(len(root) - 1):
                others = _open_partners(i, joined, block, n, sketch, i + 1)
                if not len(others):
                    continue
                own = shingles[starts[i] : starts[i] + n[i]]
                at, owner = tx.ragged(starts[others], starts[others] + n[others])
                theirs = shingles[at]
                place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                common = np.bincount(owner[own[place] == theirs], minlength=len(others))
                linked = others[(100 + PERCENT) * common >= PERCENT * (n[i] + n[others])]
                for j in linked.tolist():
                    if joined[j] != joined[i]:
                        found.append((root[i], root[j]))
                        joined[joined == joined[j]] = joined[i]
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    ordered = members.repartition("leaf").sortWithinPartitions("leaf")
    return ordered.select("leaf", "class", "root", "block", "n", "sketch", "shingles").mapInArrow(run, "a long, b long")


class _Sets:
    """Whole sets of the classes asked for so far."""

    def __init__(self, documents: DataFrame, classes: DataFrame, k: int):
        self.documents, self.classes, self.k, self.sets = documents, classes, k, None

    def of(self, wanted: DataFrame) -> DataFrame | None:
        """class, shingles of the classes in ``wanted`` and maybe others; None if there are none."""
        wanted = wanted.distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("class"), "class", "left_anti")
        wanted = stage(wanted.join(self.classes, "class").select("row.doc_id", "row.text_hash"), "path-wanted")
        if wanted.limit(1).count():
            # A class that several documents have may come from several tasks.
            more = stage(sets_of(self.documents, wanted, self.k).dropDuplicates(["class"]), "path-sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        return self.sets

    def linked(self, pairs: DataFrame) -> DataFrame | None:
        """Of the staged pairs (a, b) those whose sets link; None if there are no pairs."""
        sets = self.of(pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))))
        if sets is None:
            return None
        left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("_a"))
        right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("_b"))
        both = pairs.join(left, "a").join(right, "b")
        common, sizes = F.size(F.array_intersect("_a", "_b")), F.size("_a") + F.size("_b")
        return stage(both.where((100 + PERCENT) * common >= PERCENT * sizes).select("a", "b"), "path-links")


def _pivot_pairs(placed: DataFrame, classes: DataFrame) -> DataFrame:
    met = placed.where("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
    left = classes.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sketch_a"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sketch_b"))
    return _may_link(met.join(left, "a").join(right, "b").where("5 * least(na, nb) >= 4 * greatest(na, nb)"))


def _open(members: DataFrame) -> DataFrame:
    """Members of the nodes that hold more than one component, with the number of members, pairs between components and shingles."""
    groups = members.groupBy("node", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    square = F.col("size").cast("double") * F.col("size")
    sums = groups.groupBy("node").agg(
        F.sum("c").alias("size"), F.sum(F.col("c").cast("double") * F.col("c")).alias("within"), F.count("*").alias("roots"), F.sum("s").alias("shingles")
    )
    sums = sums.where("roots > 1").select("node", "size", "shingles", ((square - F.col("within")) / 2).alias("pairs"))
    return members.join(sums, "node")


def _blocks(members: DataFrame) -> DataFrame:
    """Members of nodes that cannot branch, dealt to every pair of blocks of their node: the exact way for the rest."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    own = F.pmod(F.xxhash64("class", "node"), "blocks")
    dealt = members.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    leaf = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    block = F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).cast("long")
    return dealt.select(leaf.alias("leaf"), "class", "root", block.alias("block"), "n")


def class_links(
    documents: DataFrame, k: int = SHINGLE, depth: int = POOL, leaf_pairs: int = LEAF_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """Classes of the documents (doc_id, text_hash, n, class; null for an empty set) and their components (class, root).

    ``depth`` bounds the levels of a tree; nodes still open there are compared in blocks.
    """
    told = stage(_signed(documents, k), "path-signed")
    one = [F.first(c).alias(c) for c in ("n", "tokens", "sketch")]
    classes = told.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), *one)
    classes, told = stage(classes, "path-classes"), told.drop("tokens", "sketch")
    sets = _Sets(documents, classes, k)

    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rooted = classes.select("class", "n", "tokens", trees).select(
        F.xxhash64("tree").alias("node"), F.shiftleft("tree", POOL).alias("path"), "class", "n", "tokens"
    )
    first = stage(_branched(rooted), "path-level")
    pivots = first.groupBy("node").agg(F.min("class").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    placed = stage(first.join(pivots.drop("size"), "node"), "path-nodes")
    links = sets.linked(stage(_pivot_pairs(placed, classes), "path-pairs"))
    none = documents.sparkSession.createDataFrame([], "class long, root long")
    known = none if links is None else stage(components(links).select(F.col("node").alias("class"), "root"), "path-roots")

    leaves, level = [], 1
    members = placed.drop("pivot").join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
    while True:
        open_ = stage(_open(members), "path-open")
        small = (F.col("pairs") <= leaf_pairs) & (F.col("size") <= LEAF_MEMBERS) & (F.col("shingles") <= LEAF_SHINGLES)
        small = small | (F.col("size") <= 2)
        leaf = F.xxhash64("node", "path").alias("leaf")
        leaves.append(open_.where(small).select(leaf, "class", "root", F.lit(-1).cast("long").alias("block"), "n"))
        large = open_.where(~small)
        if not large.limit(1).count():
            break
        if level >= min(depth, POOL - 1):
            leaves.append(_blocks(large))
            break
        children = _branched(large.drop("n").join(classes.select("class", "n", "tokens"), "class"))
        members = stage(children, "path-level").join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
        level += 1
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    sketches = classes.select("class", "sketch")
    partnered = stage(_with_partners(every.join(sketches, "class")), "path-partners")
    found = sets.of(partnered.select("class"))
    if found is None:
        return told, known
    joins = stage(_leaf_links(partnered.join(sketches, "class").join(found, "class")).distinct(), "path-joins")
    joined = components(joins).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    ends = joins.select(F.col("a").alias("class")).union(joins.select(F.col("b").alias("class"))).distinct()
    alone = ends.join(known, "class", "left_anti").select("class", F.col("class").alias("root"))
    both = known.unionByName(alone).join(joined, "root", "left")
    return told, both.select("class", F.coalesce("joined", "root").alias("root"))


def near_duplicates(documents: DataFrame, k: int = SHINGLE, depth: int = POOL, leaf_pairs: int = LEAF_PAIRS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: groups of documents linked by a similarity of 0.8 or more.

    ``documents`` has doc_id and text; other columns are ignored. Shingles are
    sets of k neighbouring words; a text with fewer words is one shingle, a null
    text or one without words has none and is linked with nothing (its
    component is its own id). component_id is the smallest doc_id that links
    reach; null ids are passed over unless a group has no other. kept says
    whether a row's id names its component. One row per row of ``documents``,
    repeated rows included; none without rows.
    """
    told, roots = class_links(documents, k, depth, leaf_pairs)
    smallest = told.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first")).join(roots, "class", "left")
    grouped = smallest.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("group_first"))
    named = smallest.join(grouped, "root", "left").select(
        F.col("class").alias("_class"), F.coalesce("group_first", "first").alias("_component")
    )
    placed = told.join(named, F.col("class") == F.col("_class"), "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("_component"))
    return placed.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
