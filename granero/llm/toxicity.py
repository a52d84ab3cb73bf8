"""Toxicity by the nearest labelled examples.

Terms are words and their beginnings of four to seven bytes. Examples are a
bounded, labelled sample; all their terms are indexed, and how many documents
hold each of them is counted over the whole table. Examples and documents are
whole TF-IDF vectors; a word that stands in no example adds to the norm of its
document as a term of one document. For every document the ``NEIGHBOURS``
examples of highest cosine are found exactly: the terms with most postings are
multiplied as a dense matrix for many documents at a time, all postings of the
others are added up. A second search counts only the terms that tell the labels
apart best, in the same vectors: a term's postings lie in blocks of examples with
the largest weight per block, the blocks of a document are visited by falling sum
of query weight times block maximum, and the search ends when that bound falls
below the similarity already reached. Neighbours of each search vote with their
similarity, weighted by how many labelled rows an example stands for; the votes
of both become probabilities by a logistic curve fitted to the examples' own
leave-one-out votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm import text as tx
from granero.session import stage

EXAMPLES = 2000  # of each label
VOCABULARY = 4096  # of the terms that tell the labels apart
NEIGHBOURS = 15
BLOCK = 32
FIRST_BLOCKS = 8  # visited at once, then four times as many each time
DENSE = 2048  # terms with the most postings, multiplied as a dense matrix for some documents at a time
TOGETHER = 256  # documents searched side by side, fewer when their telling terms have more postings than
MOST_POSTINGS = 1 << 20
ADDED = 1 << 17  # postings added up at once: what they need stays in a core's cache
STEMS = (4, 5, 6, 7)
LEAST = 4  # examples that hold a term


@dataclass
class Postings:
    """A sparse matrix by rows: entries first[i]:first[i + 1] are those of row i, by rising column."""

    first: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        """The given rows, dense."""
        at, owner = tx.ragged(self.first[rows], self.first[rows + 1])
        out = np.zeros((len(rows), self.shape[1]), np.float32)
        out[owner, self.column[at]] = self.value[at]
        return out


class Terms:
    """Numbers of term hashes, by their leading bits: hashes are spread evenly, so a slot holds less than one on average."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms  # sorted
        self.shift = np.uint64(64 - max(int(len(terms)).bit_length() + 1, 1))
        slots = np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64)
        slots[-1] -= np.uint64(1)
        self.first = np.searchsorted(terms, slots << self.shift).astype(np.int32)
        self.first[-1] = len(terms)

    def __call__(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each hash (of no meaning where it is none of the terms), and whether it is one."""
        slot = (found >> self.shift).astype(np.int64)
        place, last = self.first[slot], self.first[slot + 1]
        hit = np.zeros(len(found), bool)
        open_ = np.flatnonzero(place < last)
        while len(open_):
            same = self.terms[place[open_]] == found[open_]
            hit[open_[same]] = True
            open_ = open_[~same]
            place[open_] += 1
            open_ = open_[place[open_] < last[open_]]
        return place, hit


class Index:
    """Weights of terms x examples; what is found in them by sorting is made once in each process that searches."""

    def __init__(self, weights: Postings):
        self.weights = weights

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not isinstance(getattr(type(self), k, None), cached_property)}

    @cached_property
    def blocks(self) -> tuple[Postings, np.ndarray]:
        """Largest weight per term and block of examples; postings begin[i]:begin[i + 1] of the weights are its entry i."""
        first, example, value, (n_terms, n_examples) = (self.weights.first, self.weights.column, self.weights.value, self.weights.shape)
        block = example // BLOCK
        fresh = np.ones(len(block), bool)
        fresh[1:] = block[1:] != block[:-1]
        fresh[first[:-1][first[:-1] < len(block)]] = True
        begin = np.flatnonzero(fresh)
        most = np.maximum.reduceat(value, begin) if len(begin) else value
        maxima = Postings(np.searchsorted(begin, first), block[begin], most, (n_terms, -(-n_examples // BLOCK)))
        return maxima, np.append(begin, len(block))

    @cached_property
    def pairs(self) -> np.ndarray:
        """Example and weight of each posting in 8 bytes, to be fetched together."""
        return np.stack([self.weights.column.astype(np.int32), self.weights.value.view(np.int32)], 1).view(np.int64).ravel()

    @property
    def maxima(self) -> Postings:
        return self.blocks[0]

    @property
    def begin(self) -> np.ndarray:
        return self.blocks[1]


class Model(Index):
    """The index and what scores are made of; pickled it is the postings, 8 bytes each, and some bytes per term and example."""

    def __init__(self, weights: Postings, terms, idf, unseen, marks, toxic, counts_for, ids, curve, base):
        super().__init__(weights)
        self.terms = terms  # sorted hashes
        self.idf = idf
        self.unseen = unseen  # idf of a term of no example
        self.marks = marks  # which terms tell the labels apart
        self.toxic = toxic
        self.counts_for = counts_for  # labelled rows an example stands for
        self.ids = ids
        self.curve = curve  # of logit(score) = curve . votes
        self.base = base

    @cached_property
    def common(self) -> np.ndarray:
        """Numbers of the DENSE terms."""
        return np.sort(np.argsort(-np.diff(self.weights.first), kind="stable")[:DENSE])

    @cached_property
    def numbers(self) -> Terms:
        return Terms(self.terms)

    @cached_property
    def dense(self) -> np.ndarray:
        return self.weights[self.common]

    @cached_property
    def place(self) -> np.ndarray:
        """Row of each term in the dense matrix, -1 for the others."""
        place = np.full(len(self.terms), -1, np.int32)
        place[self.common] = np.arange(len(self.common))
        return place

    @cached_property
    def telling(self) -> Index:
        """The same vectors, with nothing but terms that tell the labels apart."""
        sizes = np.diff(self.weights.first) * self.marks
        at, _ = tx.ragged(self.weights.first[:-1][self.marks], self.weights.first[1:][self.marks])
        first = np.concatenate([[0], np.cumsum(sizes)])
        return Index(Postings(first, self.weights.column[at], self.weights.value[at], self.weights.shape))


def _term_counts(data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes of a run of documents, the document of each, and the words of each document."""
    words = tx.words_of(data, offsets, tx.ALPHANUMERIC, STEMS)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    longer = [words.ends - words.starts > size for size in STEMS]
    terms = [words.hashes, *(words.stems[keep, i] for i, keep in enumerate(longer))]
    return np.concatenate(terms), np.concatenate([owner, *(owner[keep] for keep in longer)]), np.diff(words.first)


def _with_terms(examples: DataFrame) -> DataFrame:
    """doc_id, label, n_words, terms, counts: the distinct terms of (doc_id, label, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(2)):
                terms, owner, n_words = _term_counts(data, offsets)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(high - low + 1))
                lists, counts = [], []
                for row in range(high - low):
                    found, times = np.unique(terms[order[cuts[row] : cuts[row + 1]]], return_counts=True)
                    lists.append(found.view(np.int64))
                    counts.append(times)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(n_words, pa.int64()),
                        pa.array(lists, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "label", "n_words", "terms", "counts"],
                )

    return examples.mapInArrow(run, "doc_id long, label int, n_words long, terms array<long>, counts array<long>")


def _vocabulary(examples: DataFrame, n1: int, n0: int, size: int) -> np.ndarray:
    """Sorted hashes of up to ``size`` terms that most set label 1 apart (chi-square over rows of equal labels)."""
    held = examples.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("held1"), F.sum(1 - F.col("label")).alias("held0")
    )
    p1, p0 = F.col("held1") / n1, F.col("held0") / n0
    spread = (F.col("held1") + F.col("held0")) / (n1 + n0)
    strength = (p1 - p0) * (p1 - p0) / F.greatest(spread * (1 - spread), F.lit(1e-9))
    usable = (F.col("held1") + F.col("held0") >= LEAST) & (p1 > 2 * p0) & (strength > 10.83 * (1 / n1 + 1 / n0))  # 0.1 % level
    best = held.where(usable).orderBy(strength.desc(), "term").limit(size)
    return np.sort(np.array([r["term"] for r in best.select("term").collect()], np.int64).view(np.uint64))


def _held(data, offsets, terms: Terms) -> np.ndarray:
    """The terms of a run of documents, each as often as documents hold it."""
    found, owner, _ = _term_counts(data, offsets)
    place, hit = terms(found)
    key = np.sort(owner[hit] * len(terms.terms) + place[hit])  # np.unique would hash, which takes several times as long
    return key[np.flatnonzero(np.diff(key, prepend=-1))] % len(terms.terms)


def _document_counts(documents: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """How many documents hold each of ``terms``, over all documents, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, numbers = np.zeros(len(terms), np.int64), 0, Terms(terms)
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in tx.slices(batch.column(0)):
                at = _held(data, offsets, numbers)
                total += np.bincount(at, minlength=len(terms))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(total[held], rows))], names=["at", "held"])

    partial = documents.select("text").mapInArrow(run, "at long, held long")
    summed = partial.groupBy("at").agg(F.sum("held").alias("held")).toArrow()  # a row for each term of the examples
    at, counts = summed["at"].to_numpy(), summed["held"].to_numpy()
    held = np.zeros(len(terms) + 1, np.int64)
    held[at] = counts  # documents are counted at -1
    return held[:-1], int(held[-1])


def _looked_up(data, offsets, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, document) of a run of documents, sorted by document, how often each occurs, and per document
    the sum of squared term frequencies (1 + log) of its other terms."""
    found, owner, _ = _term_counts(data, offsets)
    place, hit = terms(found)
    n_terms = max(len(terms.terms), 1)
    key, times = np.unique(owner[hit] * n_terms + place[hit], return_counts=True)
    found, owner = found[~hit], owner[~hit]
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    fresh = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])][: len(found)])
    often = np.diff(np.append(fresh, len(found)))
    rest = np.bincount(owner[fresh], (1 + np.log(often)) ** 2, len(offsets) - 1)
    return key % n_terms, key // n_terms, times, rest


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The kth largest score of each row, 0 at least."""
    n = scores.shape[1]
    return np.maximum(np.partition(scores, n - k, axis=1)[:, n - k], 0) if n > k else np.zeros(len(scores))


def _best(scores: np.ndarray, least: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The ``k`` examples of highest score above 0 of each row (ties: first example) and their scores; ``least`` is the kth."""
    best, similarity = [], []
    for row, reached in zip(scores, least, strict=True):
        found = np.flatnonzero((row > 0) & (row >= reached))
        found = found[np.lexsort((found, -row[found]))[:k]]
        best.append(found)
        similarity.append(row[found])
    return best, similarity


def nearest_of(
    index: Index, owner: np.ndarray, at: np.ndarray, weights: np.ndarray, n_docs: int, k: int, without=None
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each of ``n_docs`` documents the examples of highest cosine (ties: first example), their similarities, and how
    many blocks were scored.

    ``at`` and ``weights`` are the terms that stand in the index, ``owner`` their
    document; ``without`` is an example that does not count, or -1. Examples
    without a common term are no neighbours. The documents are searched side by
    side: each visits its blocks by falling bound, some at a time, and is done
    when the bound falls below its kth similarity.
    """
    maxima, begin = index.blocks
    n_blocks, n = maxima.shape[1], index.weights.shape[1]
    entry, pair = tx.ragged(maxima.first[at], maxima.first[at + 1])
    key, weight = owner[pair] * n_blocks + maxima.column[entry], weights[pair].astype(np.float32)
    bounds = np.bincount(key, weight * maxima.value[entry], n_docs * n_blocks).reshape(n_docs, n_blocks).astype(float)
    rank = np.empty((n_docs, n_blocks), np.int64)
    np.put_along_axis(rank, np.argsort(-bounds, axis=1, kind="stable"), np.arange(n_blocks)[None, :], 1)
    block_of = np.arange(n) // BLOCK
    scores, reached, scored = np.zeros((n_docs, n)), np.zeros(n_docs), np.zeros(n_docs, np.int64)
    first, step = 0, FIRST_BLOCKS
    while first < n_blocks:
        visited = (rank >= first) & (rank < first + step) & (bounds > 0) & (bounds >= reached[:, None] - 1e-5)
        if not visited.any():
            break
        scored += visited.sum(1)
        chosen = np.flatnonzero(visited.ravel()[key])
        low = begin[entry[chosen]]
        sizes = begin[entry[chosen] + 1] - low
        posting = np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        cell = np.repeat(key[chosen] // n_blocks * n, sizes) + index.weights.column[posting]
        values = np.bincount(cell, np.repeat(weight[chosen], sizes) * index.weights.value[posting], n_docs * n).reshape(n_docs, n).astype(float)
        values *= visited[:, block_of]
        scores += np.round(values, 6)  # equal examples are equal, however their sums were made
        if without is not None:
            scores[without >= 0, without[without >= 0]] = 0
        reached = _kth(scores, k)
        first, step = first + step, step * 4
    return *_best(scores, reached, k), scored


def _all_of(
    index: Index, owner: np.ndarray, at: np.ndarray, weights: np.ndarray, known: np.ndarray, k: int, without=None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """:func:`nearest_of` by adding up all postings: whole vectors share terms with nearly every block, so that bounds
    cost as much as they save. ``known`` has what further terms add for each document and example."""
    first, (n_docs, n) = index.weights.first, known.shape
    low = first[at]
    sizes = first[at + 1] - low
    ends = np.cumsum(sizes)
    pair = index.pairs[np.arange(int(sizes.sum())) + np.repeat(low - (ends - sizes), sizes)].view(np.int32).reshape(-1, 2)
    cell, value = np.repeat(owner * n, sizes), np.repeat(weights.astype(np.float32), sizes)
    cell += pair[:, 0]
    value *= pair.view(np.float32)[:, 1]
    scores = np.round(np.bincount(cell, value, n_docs * n).reshape(n_docs, n) + known.astype(float), 6)
    if without is not None:
        scores[without >= 0, without[without >= 0]] = 0
    return _best(scores, _kth(scores, k), k)


def nearest(index: Index, at: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """:func:`nearest_of` for one document."""
    best, similarity, scored = nearest_of(index, np.zeros(len(at), np.int64), at, weights, 1, k)
    return best[0], similarity[0], int(scored[0])


def _votes(model: Model, best: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """1, share of the weighted votes for toxic, its smoothed log odds, share times the logarithm of the mean similarity."""
    votes = similarity * model.counts_for[best]
    total = votes.sum()
    share = float((votes * model.toxic[best]).sum() / total) if total > 0 else 0.0
    if not len(best):
        return np.array([1.0, 0.0, 0.0, 0.0])
    odds = np.log((share + 0.02) / (1.02 - share))
    return np.array([1.0, share, odds, share * float(np.log(100 * similarity.mean() + 1))])


def _runs(group: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of each run of equal, rising numbers."""
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    return ((low, high) for low, high in zip(cuts, cuts[1:]) if low < high)  # noqa: B905


def _neighbours(
    model: Model, owner: np.ndarray, at: np.ndarray, weights: np.ndarray, without: dict[int, int] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of sorted ``owner`` with their votes, their neighbours by telling terms, then by whole vectors, each once, and
    the similarities. ``without`` names an example that is no neighbour of a document."""
    rows, starts = np.unique(owner, return_index=True)
    if not len(rows):
        return
    ends = np.append(starts, len(owner))[1:]
    sizes = np.diff(model.weights.first)[at]
    told_work = np.cumsum(np.add.reduceat(sizes * model.marks[at], starts))
    rare_work = np.cumsum(np.add.reduceat(sizes * (model.place[at] < 0), starts))
    for low, high in _runs(np.maximum(told_work // MOST_POSTINGS, np.arange(len(rows)) // TOGETHER)):
        some, part = rows[low:high], slice(starts[low], ends[high - 1])
        doc, term, weight = np.searchsorted(some, owner[part]), at[part], weights[part]
        left_out = None if without is None else np.array([without[r] for r in some.tolist()])
        marked = model.marks[term]
        having, number = np.unique(doc[marked], return_inverse=True)
        some_out = None if left_out is None else left_out[having]
        found = nearest_of(model.telling, number, term[marked], weight[marked], len(having), NEIGHBOURS, some_out)[:2]
        told = dict(zip(having.tolist(), zip(*found, strict=True), strict=True))
        nothing = np.zeros(0, np.int64), np.zeros(0)
        place = model.place[term]
        query = np.zeros((len(some), len(model.dense)), np.float32)
        query[doc[place >= 0], place[place >= 0]] = weight[place >= 0]
        known = query @ model.dense
        rare = np.flatnonzero(place < 0)
        for a, b in _runs(rare_work[low:high] // ADDED):
            own = rare[slice(*np.searchsorted(doc[rare], [a, b]))]
            some_out = None if left_out is None else left_out[a:b]
            whole = _all_of(model, doc[own] - a, term[own], weight[own], known[a:b], NEIGHBOURS, some_out)
            for i, best, similarity in zip(range(a, b), *whole, strict=True):
                first, share = told.get(i, nothing)
                votes = np.concatenate([_votes(model, first, share), _votes(model, best, similarity)[1:]])
                other = ~(best[:, None] == first).any(1)
                yield int(some[i]), votes, np.concatenate([first, best[other]]), np.concatenate([share, similarity[other]])


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a little shrinkage, by Newton steps."""
    beta = np.zeros(x.shape[1])
    weight = weight / weight.mean()
    shrink = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1)) * len(y) / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - shrink @ beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + shrink
        step = np.linalg.solve(bend, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


_WEIGHED = "doc_id long, label int, number long, at array<int>, weight array<float>"


def _weighed(examples: DataFrame, terms: np.ndarray, idf: np.ndarray) -> DataFrame:
    """Examples as unit vectors: doc_id, label, number (a hash of the row), numbers of their terms and weights."""
    shared = examples.sparkSession.sparkContext.broadcast((terms, idf))  # 16 bytes per term of the examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        for batch in batches:
            found = batch.column(3).flatten().to_numpy().view(np.uint64)
            sizes = pc.list_value_length(batch.column(3)).to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(terms, found)
            weight = (1 + np.log(batch.column(4).flatten().to_numpy())) * idf[at]
            weight /= np.sqrt(np.bincount(owner, weight**2, len(sizes)))[owner]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], tx.list_array(pa.array(at, pa.int32()), sizes), tx.list_array(pa.array(weight, pa.float32()), sizes)],
                names=["doc_id", "label", "number", "at", "weight"],
            )

    number = F.xxhash64("doc_id", "label", "n_words", "terms", "counts").alias("number")
    return examples.dropDuplicates().select("doc_id", "label", number, "terms", "counts").mapInArrow(run, _WEIGHED)


def _heaviest(weighed: DataFrame) -> pa.Table:
    """doc_id, label, number and heaviest term of every example."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, weight = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            sizes = pc.list_value_length(batch.column(3)).to_numpy()
            order = np.lexsort((at, -weight, np.repeat(np.arange(len(sizes)), sizes)))
            most = np.full(len(sizes), -1)
            most[sizes > 0] = at[order[(np.cumsum(sizes) - sizes)[sizes > 0]]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(most)], names=["doc_id", "label", "number", "most"])

    return weighed.mapInArrow(run, "doc_id long, label int, number long, most long").toArrow()  # 2 EXAMPLES rows


def _postings(weighed: DataFrame, row_of: dict[int, int], n_terms: int, parts: int = 16) -> Postings:
    """The weights of all terms; tasks sort the postings of a range of terms each, what comes back is 8 bytes per posting."""
    step = -(-n_terms // parts)
    shared = weighed.sparkSession.sparkContext.broadcast(row_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, number, at, weight in zip(*[batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], strict=True):
                held.setdefault(int(part), []).append((np.full(len(at), shared.value[number], np.int32), at, weight))
        for part, rows in held.items():
            row, at, weight = (np.concatenate(c) for c in zip(*rows, strict=True))
            order = np.lexsort((row, at))
            sizes = np.bincount(at - part * step, minlength=min(step, n_terms - part * step)).astype(np.int32)
            blobs = [x.tobytes() for x in (sizes, row[order], weight[order].astype(np.float32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=["part", "sizes", "row", "weight"]
            )

    each = weighed.select("number", F.posexplode(F.arrays_zip("at", "weight")).alias("_", "x"))
    part = F.floor(F.col("x.at") / step).cast("int").alias("part")
    by_part = each.groupBy(part, "number").agg(F.collect_list("x").alias("x")).select("part", "number", F.col("x.at").alias("at"), F.col("x.weight").alias("weight"))
    found = sorted(by_part.repartition(parts, "part").mapInArrow(run, "part int, sizes binary, row binary, weight binary").collect())
    by_number = {r["part"]: r for r in found}
    sizes = [
        np.frombuffer(by_number[p]["sizes"], np.int32) if p in by_number else np.zeros(max(min(step, n_terms - p * step), 0), np.int32)
        for p in range(parts)
    ]
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
    row = np.concatenate([np.frombuffer(r["row"], np.int32) for r in found])
    return Postings(first, row, np.concatenate([np.frombuffer(r["weight"], np.float32) for r in found]), (n_terms, len(row_of)))


def _leave_one_out(weighed: DataFrame, row_of: dict[int, int], model: Model) -> np.ndarray:
    """The votes of every example's neighbours but itself, seven numbers each; an example without a term has none."""
    shared = weighed.sparkSession.sparkContext.broadcast((row_of, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, model = shared.value
        for batch in batches:
            rows = [row_of[n] for n in batch.column(2).to_pylist()]
            sizes = pc.list_value_length(batch.column(3)).to_numpy()
            owner = np.repeat(np.arange(len(rows)), sizes)
            at, weight = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            done = [(rows[i], votes.tolist()) for i, votes, _, _ in _neighbours(model, owner, at, weight, dict(enumerate(rows)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in done], pa.int64()), pa.array([v for _, v in done], pa.list_(pa.float64()))], names=["row", "votes"]
            )

    x = np.tile([1.0, 0, 0, 0, 0, 0, 0], (len(row_of), 1))
    for row, votes in weighed.mapInArrow(run, "row long, votes array<double>").collect():  # 2 EXAMPLES rows
        x[row] = votes
    shared.destroy()
    return x


def fit(documents: DataFrame, labelled: DataFrame, size: int = EXAMPLES, vocabulary: int = VOCABULARY) -> Model:
    """A model from ``labelled`` (doc_id, label 0/1) and the texts of ``documents`` (doc_id, text).

    Null ids and labels are passed over; an id with both labels counts as 1.
    ``size`` bounds the examples of each label, ``vocabulary`` the telling terms. With
    no rows of one label every score is the share of label 1. Repeated rows of an
    example count once.

    Vectors, postings and the examples' own votes are made in tasks; the driver
    holds the finished model, about 8 bytes for each different term of an example.
    """
    labels = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    labels = stage(labels, "labels")
    totals = {int(r[0]): r[1] for r in labels.groupBy("label").count().collect()}
    n_rows = sum(totals.values())
    base = totals.get(1, 0) / n_rows if n_rows else 0.0
    none = np.zeros(0, np.int64)
    no_weights = Postings(np.zeros(1, np.int64), none.astype(np.int32), none.astype(np.float32), (0, 0))
    empty = Model(no_weights, none.view(np.uint64), none, 0.0, none.astype(bool), none, none, none, none, base)
    if len(totals) < 2:
        return empty
    by_hash = F.xxhash64("doc_id")
    picked = labels.where("label = 0").orderBy(by_hash, "doc_id").limit(size).union(
        labels.where("label = 1").orderBy(by_hash, "doc_id").limit(size)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id")
    examples = stage(_with_terms(texts.select("doc_id", "label", "text")), "examples")
    seen = {int(r[0]): r[1] for r in examples.groupBy("label").count().collect()}
    if len(seen) < 2:
        return empty
    telling = _vocabulary(examples, seen[1], seen[0], vocabulary)
    terms = examples.select(F.explode("terms").alias("term")).distinct().toArrow()["term"].to_numpy()
    if not len(terms):
        return empty
    terms = np.sort(terms.view(np.uint64))
    held, n = _document_counts(documents, terms)
    idf = np.log((1 + n) / (1 + held)) + 1
    weighed = stage(_weighed(examples, terms, idf), "weighed")
    # Neighbours in the index share terms: sort by the heaviest term, so that block maxima are tight.
    told = _heaviest(weighed)
    label = told["label"].to_numpy().astype(np.int64)
    order = np.lexsort((told["number"].to_numpy(), told["doc_id"].to_numpy(), told["most"].to_numpy(), -label))
    toxic, ids = label[order], told["doc_id"].to_numpy()[order]
    row_of = {n: i for i, n in enumerate(told["number"].to_numpy()[order].tolist())}
    n1 = int(toxic.sum())
    counts_for = np.where(toxic == 1, totals[1] / n1, totals[0] / (len(toxic) - n1))
    unseen = float(np.log((1 + n) / 2) + 1)
    weights = _postings(weighed, row_of, len(terms))
    model = Model(weights, terms, idf, unseen, np.isin(terms, telling), toxic, counts_for, ids, np.zeros(7), base)
    model.curve = _curve(_leave_one_out(weighed, row_of, model), toxic.astype(float), counts_for)
    return model


def _score_batch(model: Model, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    scores = np.full(len(column), model.base)
    evidence = [np.zeros(0, np.int64)] * len(column)
    similarities = [np.zeros(0)] * len(column)
    if not len(model.terms):
        return scores, evidence, similarities
    scores[:] = 1 / (1 + np.exp(-model.curve[0]))
    for low, high, data, offsets in tx.slices(column):
        at, owner, times, rest = _looked_up(data, offsets, model.numbers)
        weights = (1 + np.log(times)) * model.idf[at]
        norms = np.sqrt(np.bincount(owner, weights**2, high - low) + rest * model.unseen**2)
        weights /= norms[owner]
        for row, votes, best, values in _neighbours(model, owner, at, weights):
            scores[low + row] = 1 / (1 + np.exp(-np.clip(model.curve @ votes, -30, 30)))
            evidence[low + row] = model.ids[best]
            similarities[low + row] = values
    return scores, evidence, similarities


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence (doc_id and similarity of the neighbours): one row per row of ``documents``.

    Evidence lists the neighbours by telling terms (similarity: what these terms
    add to the cosine), then the other neighbours by whole vectors. Only the text
    is read. A null or empty text, or one without a term of the examples, has no
    neighbours and the score the curve gives to no votes.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # the terms of at most 2 EXAMPLES documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, ids, values = _score_batch(shared.value, batch.column(1))
            flat = [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in ((ids, pa.int64()), (values, pa.float64()))]
            evidence = tx.list_array(pa.StructArray.from_arrays(flat, ["doc_id", "similarity"]), np.array([len(x) for x in ids], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), evidence], names=["doc_id", "score", "evidence"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double>>")


def reject(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``documents`` without rows whose score reaches ``threshold``; columns stay as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, _, _ = _score_batch(shared.value, batch.column(at))
            yield batch.filter(pa.array(scores < threshold))

    return documents.mapInArrow(run, documents.schema)
