"""Merkle manifest of a table: one tree per language, one over their roots, and a proof for every row.

Leaves are numbered by a range sort, cut into aligned blocks of ``2 ** bits``
neighbours, and each block climbs to its top node by itself; tops are blocks of
the next tier, so a tree of any size takes one job per ``bits`` levels and no
task sees more than one block. Proofs are an octopus multiproof: a block of
leaves states the smallest set of node coordinates that it cannot derive
(siblings of its frontier, level by level), fetches these nodes in one join for
all blocks, derives every interior node above itself once, and expands the
proof of each of its leaves from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.operators.ranking import number_rows
from granero.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 12  # 4,096 leaves of 32 bytes are a block
TOP = -1  # the tree over the roots of all languages
_NODE = "tree long, n long, level int, idx long, hash binary, kind string"


def leaf(**changed: Column) -> Column:
    """The leaf of a row as 32 bytes; ``changed`` puts other values in place of columns."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        shown = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(shown, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hash(*digests: bytes) -> bytes:
    """Digest of digests, as bytes; what is hashed is their hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n."""
    return max(n - 1, 0).bit_length()


def width(n: int, level: int) -> int:
    """Nodes on a level of a tree of n leaves."""
    return -(-n >> level)


def missing(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Coordinates (level, index) needed beside the leaves ``known`` to derive the root of a tree of n leaves, none twice."""
    wanted, row = [], set(known)
    for level in range(height(n)):
        last = width(n, level) - 1
        wanted += [(level, i ^ 1) for i in sorted(row) if i ^ 1 not in row and i ^ 1 <= last]
        row = {i >> 1 for i in row}
    return wanted


def derive(leaves: dict[int, bytes], fetched: dict[tuple[int, int], bytes], n: int) -> list[dict[int, bytes]]:
    """Per level the nodes that ``leaves`` and the fetched nodes give, the root as the only node of the last one."""
    rows = [dict(leaves)]
    for level in range(height(n)):
        row, last = rows[-1], width(n, level) - 1
        row.update({i: digest for (at, i), digest in fetched.items() if at == level})
        above = {}
        for i in {i >> 1 for i in row}:
            pair = [2 * i, 2 * i + 1] if 2 * i < last else [2 * i]
            if all(p in row for p in pair):
                above[i] = _hash(*[row[p] for p in pair])
        rows.append(above)
    return rows


def proof(rows: list[dict[int, bytes]], i: int, n: int) -> list[bytes | None]:
    """Sibling of leaf i on each level; None where it stands alone."""
    return [rows[level][(i >> level) ^ 1] if (i >> level) ^ 1 < width(n, level) else None for level in range(height(n))]


def fold(digest: bytes, i: int, siblings: list[bytes | None]) -> bytes:
    """The root that a leaf and its proof give."""
    for sibling in siblings:
        digest = _hash(digest) if sibling is None else _hash(sibling, digest) if i & 1 else _hash(digest, sibling)
        i >>= 1
    return digest


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_NODES = pa.schema(
    [("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.binary()), ("kind", pa.string())]
)
_WANTS = pa.schema([*_NODES, ("block", pa.int64())])


def _climb(start: DataFrame, base: int, tallest: int, bits: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All nodes from level ``base`` up, and the roots, of the trees whose nodes of that level are ``start`` (tree, n, idx, hash).

    ``n`` counts leaves; ``tallest`` is the height of the tallest tree. One job per ``bits`` levels.
    """

    def run(table: pa.Table) -> pa.Table:
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        row = dict(zip(table["idx"].to_pylist(), table["hash"].to_pylist(), strict=True))
        top = min(height(n), low + bits)
        out = []
        for level in range(low, top):
            out += [(tree, n, level, i, digest, "node") for i, digest in row.items()]
            row = {i: _hash(*[row[p] for p in (2 * i, 2 * i + 1) if p in row]) for i in {i >> 1 for i in row}}
        kind = "root" if top == height(n) else "top"
        return _table(out + [(tree, n, top, i, digest, kind) for i, digest in row.items()], _NODES)

    nodes, roots, low = [], [], base
    while low < tallest or (low == base and not roots):
        block = F.shiftright("idx", bits).alias("block")
        tier = stage(start.groupBy("tree", block).applyInArrow(run, _NODE), "merkle-tier")
        nodes.append(tier.where("kind = 'node'"))
        roots.append(tier.where("kind = 'root'").select("tree", "hash"))
        start = tier.where("kind = 'top'").select("tree", "n", "idx", "hash")
        low += bits
    return nodes, roots


def _blocks(leaves: DataFrame, bits: int) -> DataFrame:
    """Per block of leaves: its top node, and the coordinates it is missing in its own tree and in the tree of roots."""

    def run(table: pa.Table) -> pa.Table:
        tree, n, rank, trees, block = (table[c][0].as_py() for c in ("tree", "n", "rank", "trees", "block"))
        row = dict(zip(table["idx"].to_pylist(), table["leaf"].to_pylist(), strict=True))
        wants = [(tree, n, level, i, None, "want", block) for level, i in missing(row, n)]
        wants += [(TOP, trees, level, i, None, f"want {tree}", block) for level, i in missing([rank], trees)]
        top = min(height(n), bits)
        for _ in range(top):
            row = {i: _hash(*[row[p] for p in (2 * i, 2 * i + 1) if p in row]) for i in {i >> 1 for i in row}}
        kind = "root" if top == height(n) else "top"
        return _table(wants + [(tree, n, top, i, digest, kind, block) for i, digest in row.items()], _WANTS)

    return leaves.groupBy("tree", "block").applyInArrow(run, _NODE + ", block long")


_PROVED = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.string()) for c in ("lang", "leaf", "subroot", "proof_sha256", "folded_root")]
)


def _prove(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    n, rank, trees = (leaves[c][0].as_py() for c in ("n", "rank", "trees"))
    own = dict(zip(leaves["idx"].to_pylist(), leaves["leaf"].to_pylist(), strict=True))
    nodes: tuple[dict, dict] = ({}, {})
    for of, level, i, digest in zip(*[fetched[c].to_pylist() for c in ("of", "level", "idx", "hash")], strict=True):
        nodes[of == TOP][level, i] = digest
    inside = derive(own, nodes[0], n)
    subroot = inside[-1][0]
    above = derive({rank: subroot}, nodes[1], trees)
    upper = proof(above, rank, trees)
    out = []
    for doc_id, lang, i, given in zip(*[leaves[c].to_pylist() for c in ("doc_id", "lang", "idx", "presented")], strict=True):
        lower = proof(inside, i, n)
        told = "".join(s.hex() for s in lower + upper if s is not None)
        folded = fold(fold(given, i, lower), rank, upper)
        out.append((doc_id, lang, own[i].hex(), subroot.hex(), hashlib.sha256(told.encode()).hexdigest(), folded.hex()))
    return _table(out, _PROVED)


def manifest(rows: DataFrame, presented: Column | None = None, bits: int = BITS) -> DataFrame:
    """Every row of ``rows`` (doc_id, source, lang, n_chars, text) with its place in the manifest.

    Columns: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root,
    verified. ``presented`` is the leaf that a holder of the row shows (where it
    is null the row's own): it is folded with the proof, and verified when that
    gives the root.

    Nulls count as ``-`` in a leaf; a null lang is a tree of its own, the first;
    a null doc_id comes first in its tree. Rows with equal doc_id and lang stand
    in the order of their leaves, equal rows in any order, each with a proof of
    its own. Empty texts are values. Without rows the result has none. Other
    columns are ignored.
    """
    shown = F.lit(None).cast("binary") if presented is None else presented
    hashed = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf().alias("leaf"), shown.alias("presented")
    )
    # Equal rows, however many, are dealt over several ranges.
    hashed = stage(hashed.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())), "merkle-leaves")
    numbered = number_rows(hashed, ["lang", "doc_id", "leaf", "_spread"])
    langs = numbered.groupBy("lang").agg((F.min("_pos") - 1).alias("tree"), F.count("*").alias("n"))
    langs = stage(langs, "merkle-trees")
    ranked = number_rows(langs, ["tree"]).select(
        F.col("lang").alias("_lang"), "tree", "n", (F.col("_pos") - 1).alias("rank"), F.col("_total").alias("trees")
    )
    leaves = numbered.join(ranked, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "doc_id",
        "lang",
        "leaf",
        F.coalesce("presented", "leaf").alias("presented"),
        "tree",
        "n",
        "rank",
        "trees",
        (F.col("_pos") - 1 - F.col("tree")).alias("idx"),
    )
    leaves = leaves.withColumn("block", F.shiftright("idx", bits))

    first = stage(_blocks(leaves, bits), "merkle-blocks")
    extent = langs.agg(F.max("n").alias("longest"), F.count("*").alias("trees")).first()
    tallest, trees = height(extent["longest"] or 0), extent["trees"]
    roots = [first.where("kind = 'root'").select("tree", "hash")]
    nodes: list[DataFrame] = []
    if tallest > bits:
        open_ = first.where("kind = 'top'").select("tree", "n", "idx", "hash")
        nodes, more = _climb(open_, bits, tallest, bits)
        roots += more
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    top = subroots.join(ranked.select("tree", "rank", "trees"), "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("trees").alias("n"), F.col("rank").alias("idx"), "hash"
    )
    upper, crown = _climb(top, 0, height(trees), bits)
    root = crown[-1].first()  # one row of 32 bytes
    stored = upper[0]
    for more in upper[1:] + nodes:
        stored = stored.unionByName(more)

    own = F.when(F.col("tree") == TOP, F.substring("kind", 6, 20).cast("long")).otherwise(F.col("tree"))
    wants = first.where("kind LIKE 'want%'").select(own.alias("_tree"), "block", F.col("tree").alias("of"), "level", "idx")
    fetched = wants.join(stored.select(F.col("tree").alias("of"), "level", "idx", "hash"), ["of", "level", "idx"])
    fetched = fetched.select(F.col("_tree").alias("tree"), "block", "of", "level", "idx", "hash")
    schema = "doc_id long, lang string, leaf string, subroot string, proof_sha256 string, folded_root string"
    proved = leaves.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(_prove, schema)
    published = F.lit(bytes(root["hash"]).hex() if root else None).cast("string")
    return proved.select(
        "doc_id", "lang", "leaf", "subroot", published.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == published).alias("verified")
    )
