"""Exact top-k search by inner product with block-at-a-time pruning.

A dimension with its sign is a term: a vector has the weight ``x`` of the term
(d, +) or ``-x`` of (d, -). Rows lie in ranges of vector ids; a range is a
forward index of blocks, each with the largest weight of every term in it. For a
query the blocks of a range are ordered by the sum of its term weights times
those maxima, an upper bound of every score inside, and scored in that order
until a bound falls below the query's k-th score so far. Many queries meet a
range at once; where most blocks can still matter, the whole range is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.session import stage

BLOCK = 64  # rows whose term maxima are kept together
RANGE = 4096  # rows of one forward index
QUERIES = 512  # queries compared with a range at once
CELL = 2 * RANGE  # rows that one task searches at least
CELLS = 128  # tasks that the rows are dealt to, unless these would hold more than
CELL_BYTES = 512 << 20  # components of 8 bytes each
GROUP_BYTES = 128 << 20  # the same for the queries that a task holds
AT_ONCE = 8  # blocks of a query that are scored before its bounds are looked at again
SCALE = 1024
_EXACT = 2**53
_EXACT_SINGLE = 2**24
_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: components as floor(scale * x); vectors that are null or hold a null or non-finite component are left out."""
    x = F.col("embedding")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(rows: pa.ListArray) -> np.ndarray:
    """Rows of a list column as one matrix; shorter vectors are filled with zeros."""
    sizes = np.diff(np.asarray(rows.offsets))
    flat = np.asarray(rows.flatten(), np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _narrowest(values: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them all."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return values.astype(kind)


def _packed(rows: DataFrame, group: str, most: int) -> DataFrame:
    """Rows of a partition by vec_id, ``most`` in a row: partition, place in it, ids, and matrix as bytes of a width."""

    def packed(part: pa.Table, place: int) -> pa.RecordBatch:
        lists = part.column("v").combine_chunks()
        values = _narrowest(_matrix(lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists))
        ids = part.column("vec_id").to_numpy().astype("<i8")
        numbers = [pa.array([x], pa.int64()) for x in (TaskContext.get().partitionId(), place)]
        columns = [*numbers, pa.array([ids.tobytes()]), pa.array([values.tobytes()]), pa.array([values.itemsize], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=[group, "place", "ids", "matrix", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, place = [], 0, 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            while n >= most:
                part = pa.Table.from_batches(held)
                yield packed(part.slice(0, most), place)
                held, n, place = part.slice(most).to_batches(), n - most, place + 1
        if n:
            yield packed(pa.Table.from_batches(held), place)

    ordered = rows.select("vec_id", "v").sortWithinPartitions("vec_id")
    return ordered.mapInArrow(run, f"{group} long, place long, ids binary, matrix binary, width int")


def _unpacked(ids: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(matrix, f"<i{width}").reshape(len(names), len(matrix) // (width * len(names)))


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def _product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products; floats only while every sum stays below 2 ** 53."""
    largest = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, rows.shape[1])
    if largest < _EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if largest < 2**62:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Forward:
    """Rows of one range as a forward index: the maxima of its blocks, and the rows as the numbers that are multiplied."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.cuts = np.arange(0, len(rows), BLOCK)
        self.smallest_id = int(ids.min(initial=_HIGHEST))
        plain = rows.astype(np.float64)
        self.largest = float(np.abs(plain).max(initial=0))
        self.norm = float(np.sqrt((plain**2).sum(axis=1)).max(initial=0))
        highest = np.maximum.reduceat(rows, self.cuts, axis=0)
        lowest = np.minimum.reduceat(rows, self.cuts, axis=0)
        self.maxima = np.hstack([np.maximum(highest, 0).astype(np.float64), np.maximum(-lowest.astype(np.float64), 0)])
        self._as: dict[type, np.ndarray] = {np.float64: plain}

    def block(self, b: int) -> slice:
        return slice(self.cuts[b], min(self.cuts[b] + BLOCK, len(self.rows)))

    def numbers(self, kind: type | None) -> np.ndarray:
        if kind is None:
            return self.rows
        if kind not in self._as:
            self._as[kind] = self.rows.astype(kind)
        return self._as[kind]


class Nearest:
    """The k best rows so far of each query of a block: highest score first, of equal scores the smaller id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.floor = np.full(len(query_ids), _LOWEST) if floor is None else floor.astype(np.int64)
        self.scores = np.full((len(query_ids), k), _LOWEST)
        self.ids = np.full((len(query_ids), k), _HIGHEST)
        self.held = np.zeros(len(query_ids), np.int64)
        plain = queries.astype(np.float64)
        self.largest = float(np.abs(plain).max(initial=0))
        self.norm = float(np.sqrt((plain**2).sum(axis=1)).max(initial=0))

    def reached(self) -> np.ndarray:
        """Scores that k rows are known to reach."""
        return np.where(self.held == self.k, np.maximum(self.floor, self.scores[:, -1]), self.floor)

    def _kind(self, f: Forward) -> type | None:
        """Floats as long as every sum of products is a whole number that they hold; None beyond that.

        No sum of some of the products of two vectors is larger than the product of their lengths.
        """
        if self.norm * f.norm < _EXACT_SINGLE - 1:
            return np.float32
        return np.float64 if self.largest * f.largest * max(1, self.queries.shape[1], f.rows.shape[1]) < _EXACT else None

    def _products(self, f: Forward, places: slice, chosen: np.ndarray | slice, kind: type | None) -> np.ndarray:
        rows, queries = f.numbers(kind)[places], self.queries[chosen]
        width = max(rows.shape[1], queries.shape[1])
        if kind is None:
            return _product(_wide(queries, width).astype(np.int64), _wide(rows, width).astype(np.int64))
        return _wide(queries.astype(kind), width) @ _wide(rows, width).T

    def _bounds(self, f: Forward) -> np.ndarray:
        """Per query and block a score that no row of the block exceeds."""
        queries = self.queries.astype(np.float64)
        sides = f.maxima.reshape(len(f.cuts), 2, -1)
        width = max(queries.shape[1], sides.shape[2])
        maxima = np.hstack([_wide(sides[:, 0], width), _wide(sides[:, 1], width)])
        queries = _wide(queries, width)
        return np.hstack([np.maximum(queries, 0), np.maximum(-queries, 0)]) @ maxima.T

    def _probed(self, f: Forward, bounds: np.ndarray, kind: type | None) -> np.ndarray:
        """Scores that k rows reach in the blocks with the highest bounds, where k rows are there."""
        at = np.argpartition(-bounds, AT_ONCE - 1, axis=1)[:, :AT_ONCE]
        scores = np.full((len(self.query_ids), AT_ONCE * BLOCK), -np.inf)
        for b in np.unique(at):
            chosen, nth = np.nonzero(at == b)
            places = f.block(b)
            found = self._products(f, places, chosen, kind).astype(np.float64)
            found[f.ids[places] == self.query_ids[chosen][:, None]] = -np.inf
            scores[chosen[:, None], nth[:, None] * BLOCK + np.arange(found.shape[1])] = found
        kth = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
        return np.where(np.isfinite(kth), np.maximum(np.where(np.isfinite(kth), kth, 0).astype(np.int64), self.floor), self.floor)

    def _candidates(self, f: Forward, places: slice, chosen: np.ndarray, least: np.ndarray, kind: type | None) -> tuple[np.ndarray, ...]:
        scores = self._products(f, places, chosen, kind)
        enough = scores >= (least[chosen] if kind is None else least[chosen].astype(kind))[:, None]
        which, place = np.divmod(np.flatnonzero(enough.ravel()), max(1, scores.shape[1]))  # of few in many faster than by row and column
        found = scores[which, place].astype(np.int64)
        which, ids = chosen[which], f.ids[places][place]
        other = ids != self.query_ids[which]
        return which[other], ids[other], found[other]

    def _keep(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(which):
            return
        touched = np.unique(which)
        old, place = np.nonzero(np.arange(self.k) < self.held[touched][:, None])
        old = touched[old]
        which = np.concatenate([which, old])
        ids, scores = np.concatenate([ids, self.ids[old, place]]), np.concatenate([scores, self.scores[old, place]])
        order = np.lexsort((ids, ~scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        starts = np.searchsorted(which, touched)
        rank = np.arange(len(which)) - np.repeat(starts, np.diff(np.append(starts, len(which))))
        best = rank < self.k
        self.ids[which[best], rank[best]] = ids[best]
        self.scores[which[best], rank[best]] = scores[best]
        self.held[touched] = np.bincount(np.searchsorted(touched, which[best]), minlength=len(touched))

    def _least(self, f: Forward) -> np.ndarray:
        """What a row has to score: as much as the k-th, or more where its id comes behind the k-th one's."""
        kth = self.scores[:, -1]
        behind = (self.held == self.k) & (self.ids[:, -1] <= f.smallest_id) & (kth < _HIGHEST)
        return np.maximum(np.where(behind, kth + behind, np.where(self.held == self.k, kth, _LOWEST)), self.floor)

    def take(self, f: Forward) -> int:
        """Search one range; returns the number of blocks that were scored."""
        kind, everyone = self._kind(f), np.arange(len(self.query_ids))
        if kind is None or len(f.cuts) <= AT_ONCE:
            self._keep(*self._candidates(f, slice(0, len(f.rows)), everyone, self._least(f), kind))
            return len(f.cuts) * len(everyone)
        bounds, scored = self._bounds(f), 0
        if (self.held < self.k).any() and self.k <= AT_ONCE * BLOCK:
            self.floor = self._probed(f, bounds, kind)
            scored += AT_ONCE * len(everyone)
        alive = bounds >= self.reached()[:, None]
        if 4 * np.count_nonzero(alive) > alive.size:
            chosen = np.nonzero(alive.any(axis=1))[0]
            self._keep(*self._candidates(f, slice(0, len(f.rows)), chosen, self._least(f), kind))
            return scored + len(f.cuts) * len(chosen)
        while alive.any():
            now = np.zeros_like(alive)
            best = np.argpartition(np.where(alive, -bounds, np.inf), AT_ONCE - 1, axis=1)[:, :AT_ONCE]
            np.put_along_axis(now, best, True, axis=1)
            now &= alive
            scored += int(np.count_nonzero(now))
            least = self._least(f)
            found = [self._candidates(f, f.block(b), np.nonzero(now[:, b])[0], least, kind) for b in np.nonzero(now.any(axis=0))[0]]
            self._keep(*(np.concatenate(c) for c in zip(*found, strict=True)))
            alive = alive & ~now & (bounds >= self.reached()[:, None])
        return scored

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query, id, score of all rows that are held."""
        query, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        return self.query_ids[query], self.ids[query, place], self.scores[query, place]


def search_range(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray
) -> tuple[list[tuple[int, int, int]], np.ndarray, int]:
    """The k best rows of one range for each query: (query, id, score); the k-th scores; blocks scored.

    ``floor`` holds scores already known to be reached by k other rows; what
    cannot come up to it is not scored.
    """
    best = Nearest(query_ids, queries, k, floor)
    scored = best.take(Forward(ids, rows))
    found = [tuple(int(x) for x in row) for row in zip(*best.found(), strict=True)]
    return found, best.reached(), scored


def _search(batches: Iterator[pa.RecordBatch], k: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Each cell has its queries first, which are held with their best rows, and then its ranges, which stream by."""
    cell, asked, best = None, [], None

    def grouped() -> list[Nearest]:
        if not asked:
            return []
        width = max(m.shape[1] for _, m in asked)
        ids, matrix = np.concatenate([i for i, _ in asked]), np.concatenate([_wide(m, width) for _, m in asked])
        return [Nearest(ids[at : at + at_once], matrix[at : at + at_once], k) for at in range(0, len(ids), at_once)]

    def results() -> Iterator[pa.RecordBatch]:
        for block in best or []:
            columns = [pa.array(c, pa.int64()) for c in block.found()]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    for batch in batches:
        for n in range(batch.num_rows):
            row = {name: batch.column(name)[n] for name in batch.schema.names}
            ids, matrix = _unpacked(row["ids"].as_buffer(), row["matrix"].as_buffer(), row["width"].as_py())
            if row["cell"].as_py() != cell:
                yield from results()
                cell, asked, best = row["cell"].as_py(), [], None
            if row["is_range"].as_py():
                best = grouped() if best is None else best
                forward = Forward(ids, matrix) if best else None
                for block in best:
                    block.take(forward)
            else:
                asked.append((ids.copy(), matrix.copy()))
    yield from results()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of ``vectors`` with the highest integer inner product per query.

    Both frames have vec_id and embedding. A query never finds rows with its own
    id. Ties go to the smaller vec_id. A repeated query id is answered once,
    with its largest vector in array order; rows of ``vectors`` that repeat an id
    and its vector count once, rows with one id and different vectors each. Vectors that are null, hold a
    null or non-finite component, or have no id take no part; a shorter vector
    counts as filled with zeros; products beyond 64 bits are held at its limits.
    With no rows or no queries the result is empty.

    Rows are dealt by id to cells, queries to groups that a task can hold; every
    group meets every cell in a task, where the ranges of the cell stream by. Nothing
    is joined, so no side is broadcast, and a task returns k rows per query at most.
    """
    rows = stage(quantized(vectors, scale).distinct(), "vectors")
    n, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    size = 8 * max(1, longest or 0)
    n_cells = max(1, min(CELLS, -(-n // CELL)), -(-n * size // CELL_BYTES))
    ranged = rows.repartitionByRange(n_cells, "vec_id", F.xxhash64("v"))
    forward = stage(_packed(ranged, "cell_no", RANGE), "forward")
    asked = stage(quantized(queries, scale).groupBy("vec_id").agg(F.max("v").alias("v")), "asked")
    n_asked, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n_groups = max(1, -(-n_asked * 8 * max(1, longest or 0) // GROUP_BYTES))
    n_blocks = n_groups * max(1, min(CELLS, -(-n_asked // QUERIES)) // n_groups)  # as many for each group
    blocks = _packed(asked.repartition(n_blocks, "vec_id"), "block_no", QUERIES)
    last = forward.agg(F.max("cell_no")).first()[0]
    cells = 0 if last is None else last + 1  # a partition without rows has no range
    packed = ["place", "ids", "matrix", "width"]
    group, cell = F.col("group"), F.col("cell")
    sides = [
        forward.select(F.explode(_numbers(n_groups)).alias("group"), F.col("cell_no").alias("cell"), F.lit(True).alias("is_range"), *packed),
        blocks.select(
            F.explode(_numbers(cells)).alias("cell"), (F.col("block_no") % n_groups).alias("group"), F.lit(False).alias("is_range"), *packed
        ),
    ]
    dealt = (
        sides[0]
        .unionByName(sides[1])
        .withColumn("cell", group * cells + cell)
        .repartitionById(max(1, n_groups * cells), F.col("cell").cast("int"))
        .sortWithinPartitions("cell", "is_range", "place")
        .select("cell", "is_range", "ids", "matrix", "width")
    )
    at_once = QUERIES  # goes with the function to the tasks
    found = dealt.mapInArrow(lambda batches: _search(batches, k, at_once), "query_id long, vec_id long, score long")
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _numbers(n: int) -> Column:
    """0 to n - 1."""
    return (F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array()).cast("array<long>")
