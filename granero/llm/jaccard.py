"""Exact near-duplicate join on word shingles in the Jaccard metric space.

1 - J is a metric, so a pair within radius r lies at distances from any pivot
that differ by at most r. Classes (texts with equal shingle sets) that can link
share a shingle among the first quarter of their sets in a common order; every
shingle shared there makes a region. Its pivot is the member that shares most of
its leading shingles with others, and a class is replicated to all regions whose
pivot it shares a leading shingle with, the only ones that can hold partners.
First the distances of all members to their pivot are computed from whole sets,
which connects most of what is alike. A region whose members are all connected
is done. Each of the others is joined in a task of its own: the window of the
triangle inequality around the pivot and the number of leading shingles two
members have in common leave pairs out, the rest is compared on whole sets, and
only links come out. A region too large for a task is dealt to the pairs of its
blocks of members.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm import text as tx
from granero.llm.components import components
from granero.session import stage

SHINGLE = 5
COUNTERS = 1 << 20  # of the frequency sketch; its size is fixed
PARTS = 64
FILTER_BITS = 1 << 26  # of the filter that picks the sets to compare: 8 MB at every size
ENTRY = np.dtype([("shingle", "<u8"), ("class", "<i8")])
REGION_MEMBERS, REGION_SHINGLES = 1 << 13, 1 << 23  # of a region that is joined in one task
REGION_BLOCK = 512
PARTITION_BYTES = 32 << 20


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text; fewer than k words are one shingle, none is empty."""
    for low, high, data, offsets in tx.slices(column):
        words = tx.words_of(data, offsets, tx.NOT_BLANK)
        grams = words.grams(k)
        for row in range(high - low):
            a, b = int(words.first[row]), int(words.first[row + 1])
            if b - a >= k:
                yield low + row, np.unique(grams[a : b - k + 1])
            elif b > a:
                yield low + row, tx.Words(None, None, words.hashes[a:b], None).grams(b - a)
            else:
                yield low + row, np.zeros(0, np.uint64)


def class_of(shingles: np.ndarray) -> int:
    """One number for a set of shingles."""
    total = np.sum(tx.mix(shingles ^ np.uint64(0x51ED270B27B4F3CF)), dtype=np.uint64) + np.uint64(len(shingles))
    return int(tx.mix(np.array([total], np.uint64)).view(np.int64)[0])


def prefix_length(n):
    """A set of n shingles shares one of its first so many, in any fixed order, with every set it links to."""
    return n - (3 * n + 3) // 4 + 1


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)  # the top 20 bits


def _classes(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n, class per document; in rows of their own part, counts: how often shingles of a counter occurred."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        names = ["doc_id", "text_hash", "n", "class", "part", "counts"]
        for batch in batches:
            sizes, classes, seen = [], [], []
            for _, shingles in shingle_sets(batch.column(2), k):
                sizes.append(len(shingles))
                classes.append(class_of(shingles) if len(shingles) else None)
                seen.append(_counter(shingles))
                if sum(map(len, seen[-1:])) and len(seen) >= 512:
                    counts += np.bincount(np.concatenate(seen), minlength=COUNTERS).astype(np.uint32)
                    seen = []
            if seen:
                counts += np.bincount(np.concatenate(seen), minlength=COUNTERS).astype(np.uint32)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=names,
            )
        if counts.any():
            blobs = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(PARTS, -1)]
            empty = pa.nulls(PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [empty, empty, empty, empty, pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], names=names
            )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(run, "doc_id long, text_hash long, n long, class long, part int, counts binary")


def _levels(rows: DataFrame) -> np.ndarray:
    """For each counter how many doublings it lies above what chance puts there; frequent shingles get a late place.

    A counter holds the shingles of its hash range, on average ``mean``
    occurrences, give or take the root of that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32).astype(np.uint64)
                totals[part] = totals[part] + counts if part in totals else counts
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["part", "counts"]
            )

    summed = rows.where("part IS NOT NULL").select("part", "counts").repartition(PARTS, "part").mapInArrow(run, "part int, counts binary")
    load = np.zeros((PARTS, COUNTERS // PARTS))
    for part, blob in summed.collect():  # PARTS rows of a fixed size
        load[part] = np.frombuffer(blob, np.uint64)
    load = load.ravel()
    surplus = (load - load.mean()) / (4 * np.sqrt(load.mean()) + 4)
    return np.clip(np.floor(np.log2(np.maximum(surplus, 0.5))) + 1, 0, 60).astype(np.uint8)


def _entries(documents: DataFrame, levels: np.ndarray, k: int, buckets: int) -> DataFrame:
    """bucket, entries: leading shingles of every class, dealt by shingle in binary blocks."""
    shared = documents.sparkSession.sparkContext.broadcast(levels)  # COUNTERS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen, held, size = shared.value, set(), [], 0

        def flush():
            rows = np.concatenate(held)
            bucket = (tx.mix(rows["shingle"]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            blobs = [(b, rows[order[cuts[b] : cuts[b + 1]]].tobytes()) for b in range(buckets) if cuts[b] < cuts[b + 1]]
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], names=["bucket", "entries"]
            )

        for batch in batches:
            for _, shingles in shingle_sets(batch.column(0), k):
                n = len(shingles)
                if not n or (name := class_of(shingles)) in seen:
                    continue
                seen.add(name)
                late = level[_counter(shingles)]
                if late.any():
                    shingles = shingles[np.argsort(late, kind="stable")]
                entries = np.empty(prefix_length(n), ENTRY)
                entries["shingle"] = shingles[: len(entries)]
                entries["class"] = name
                held.append(entries)
                size += len(entries)
                if size >= 1 << 20:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return documents.select("text").mapInArrow(run, "bucket int, entries binary")


def _postings(entries: DataFrame, partitions: int) -> DataFrame:
    """shingle, class: the members of the regions, shingles that two classes at least have among their leading ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(blob.as_py(), ENTRY) for batch in batches for blob in batch.column(0)]
        if not held:
            return
        rows = np.concatenate(held)
        del held
        rows = rows[np.argsort(rows["shingle"], kind="stable")]
        same = np.zeros(len(rows) + 1, bool)
        same[1:-1] = rows["shingle"][1:] == rows["shingle"][:-1]
        rows = rows[same[:-1] | same[1:]]
        rows = rows[np.lexsort((rows["class"], rows["shingle"]))]
        if not len(rows):
            return
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows["shingle"][1:] != rows["shingle"][:-1]) | (rows["class"][1:] != rows["class"][:-1])
        rows = rows[fresh]
        first = np.flatnonzero(np.concatenate([[True], rows["shingle"][1:] != rows["shingle"][:-1]]))
        sizes = np.diff(np.append(first, len(rows)))
        rows = rows[np.repeat(sizes > 1, sizes)]
        for low in range(0, len(rows), 100_000):
            part = rows[low : low + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(part["shingle"]).view(np.int64)), pa.array(np.ascontiguousarray(part["class"]))],
                names=["shingle", "class"],
            )

    dealt = entries.repartition(partitions, "bucket").select("entries")
    return dealt.mapInArrow(run, "shingle long, class long")


def _row_key():
    return F.xxhash64("doc_id", "text_hash")


def sets_of(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """class, shingles of the documents named in ``wanted`` (doc_id, text_hash), and of a few more that the filter lets through.

    The filter is a bitmap of fixed size over the rows' hashes: the more rows
    are wanted, the more others pass it, which costs but changes nothing.
    """
    bit = F.pmod("row_key", F.lit(FILTER_BITS))
    bits = wanted.select(_row_key().alias("row_key")).select(F.floor(bit / 32768).alias("bucket"), (bit % 32768).alias("bit"))
    filled = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for bucket, part in bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():  # FILTER_BITS at most
        filled[bucket] = np.frombuffer(part, np.uint8)
    shared = documents.sparkSession.sparkContext.broadcast(filled.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, seen = shared.value, set()
        for batch in batches:
            at = batch.column(0).to_numpy() % FILTER_BITS
            batch = batch.filter(pa.array((bitmap[at >> 3] >> (at & 7) & 1).astype(bool)))
            names, sets, size = [], [], 0

            def made(names, sets):
                return pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), tx.list_array(pa.array(np.concatenate(sets).view(np.int64)), np.array([len(s) for s in sets]))],
                    names=["class", "shingles"],
                )

            for _, shingles in shingle_sets(batch.column(1), k):
                if not len(shingles) or (name := class_of(shingles)) in seen:
                    continue
                seen.add(name)
                names.append(name)
                sets.append(shingles)
                size += len(shingles)
                if size > 1 << 20:
                    yield made(names, sets)
                    names, sets, size = [], [], 0
            if names:
                yield made(names, sets)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.select(_row_key().alias("row_key"), "text").mapInArrow(run, "class long, shingles array<long>")


def _needed(n: Column, m: Column) -> Column:
    """Common shingles that sets of n and m need to link."""
    return F.ceil((n + m) * F.lit(3) / F.lit(7))


def _may_link(n: Column, m: Column, common: Column) -> Column:
    """Whether sets of n and m, three quarters of each other at least, with so many common leading shingles can link.

    Of the two last leading shingles take the earlier one: whatever both sets
    have up to it is leading in both and was counted, and behind it the set that
    it belongs to has all but its leading shingles.
    """
    behind = F.greatest(F.ceil(n * 0.75), F.ceil(m * 0.75)) - 1
    return common + behind >= _needed(n, m)


SIGNATURE = ["bits0", "bits1", "bits2", "bits3"]


def _of_word(leading: Column, word: int) -> Column:
    return F.filter(leading, lambda x: x.bitwiseAND(F.lit(3)) == word)


def _most_common(p: str, y: str) -> Column:
    """No less than the leading shingles that two classes share: common bits, and what may hide behind one bit."""
    bits = sum(F.bit_count(F.col(f"{p}.{c}").bitwiseAND(F.col(f"{y}.{c}"))) for c in SIGNATURE)
    return bits + F.least(f"{p}.slack", f"{y}.slack")


def _signature(leading: Column) -> list[Column]:
    """A bit for each leading shingle, in four words."""
    words = []
    for i, name in enumerate(SIGNATURE):
        bits = F.aggregate(
            _of_word(leading, i),
            F.lit(0).cast("long"),
            lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, 2).bitwiseAND(F.lit(63)))),
        )
        words.append(bits.alias(name))
    return words


class _Comparison:
    """Whole sets of the classes that were compared so far, and the distances of pairs."""

    def __init__(self, documents: DataFrame, members: DataFrame, k: int):
        self.documents, self.members, self.k, self.sets = documents, members, k, None

    def sets_for(self, wanted: DataFrame) -> DataFrame | None:
        """class, shingles of the classes in ``wanted`` and maybe of others; None if there are none at all."""
        wanted = wanted.distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("class"), "class", "left_anti")
        wanted = stage(wanted.join(self.members, "class").select("doc_id", "text_hash"), "wanted")
        if wanted.limit(1).count():
            # A class that several documents have may come from several tasks.
            more = stage(sets_of(self.documents, wanted, self.k).dropDuplicates(["class"]), "sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        return self.sets

    def __call__(self, met: DataFrame) -> DataFrame | None:
        """a, b, common, distance, linked for those of the pairs (a, b) that may link; None if none may."""
        def side(name):
            columns = {"class": name, "n": f"n{name}", "leading": f"leading_{name}", "lost": f"lost_{name}"}
            return self.members.select(*[F.col(c).alias(new) for c, new in columns.items()])

        left, right = side("a"), side("b")
        shared = F.size(F.array_intersect("leading_a", "leading_b")) + F.least("lost_a", "lost_b")
        near = (shared > 0) & _may_link(F.col("na"), F.col("nb"), shared)
        met = stage(met.distinct().join(left, "a").join(right, "b").where(near).select("a", "b", "na", "nb"), "pairs")
        if not met.limit(1).count():
            return None
        self.sets_for(met.select(F.col("a").alias("class")).union(met.select(F.col("b").alias("class"))))
        left = self.sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
        right = self.sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        both = met.join(left, "a").join(right, "b").select("a", "b", (F.col("na") + F.col("nb")).alias("n"), common.alias("common"))
        union = F.col("n") - F.col("common")
        linked = (100 * F.col("common") >= 75 * union).alias("linked")
        distance = (1 - F.col("common") / union).alias("distance")
        return stage(both.distinct().select("a", "b", "common", distance, linked), "compared")


def _open_regions(rooted: DataFrame) -> DataFrame:
    """Members of the regions that hold more than one component: region, class, root, n, distance, block.

    A region that is too large for a task is dealt to the pairs of its blocks of
    members, which meet each in a task of its own.
    """
    groups = rooted.groupBy("home", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sums = groups.groupBy("home").agg(F.sum("c").alias("size"), F.sum("s").alias("shingles"), F.count("*").alias("roots"))
    placed = rooted.join(sums.where("roots > 1").drop("roots"), "home")
    alone = (F.col("size") <= REGION_MEMBERS) & (F.col("shingles") <= REGION_SHINGLES)
    columns = [F.col("class"), F.col("root"), F.col("n").cast("long").alias("n"), F.coalesce("distance", F.lit(-1.0)).alias("distance")]
    whole = placed.where(alone).select(F.xxhash64("home").alias("region"), *columns, F.lit(-1).cast("long").alias("block"))
    dealt = placed.where(~alone).withColumn("blocks", F.ceil(F.col("size") / F.lit(REGION_BLOCK)).cast("long"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class", "home"), "blocks")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    region = F.xxhash64("home", F.least("own", "other"), F.greatest("own", "other"))
    block = F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).cast("long")
    return whole.unionByName(dealt.select(region.alias("region"), *columns, block.alias("block")))


def _by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Columns of one region after the other from rows that come sorted by region; lists are joined to one array."""

    def piece(part: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {
            name: (column.flatten() if pa.types.is_list(column.type) else column).to_numpy(zero_copy_only=False)
            for name, column in zip(part.schema.names, part.columns, strict=True)
        }

    def joined(pieces: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        return {name: np.concatenate([p[name] for p in pieces]) for name in pieces[0]}

    current, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        region = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
        for low, high in zip(cuts, cuts[1:]):  # noqa: B905
            if region[low] != current:
                if held:
                    yield current, joined(held)
                current, held = region[low], []
            held.append(piece(batch.slice(low, high - low)))
    if held:
        yield current, joined(held)


def _others(i: int, root: np.ndarray, r: dict[str, np.ndarray]) -> np.ndarray:
    """Members behind member i that are not connected with it, fit its size and lie in its window of distances to the centre."""
    n, distance, block = r["n"], r["distance"], r["block"]
    rest = slice(i + 1, None)
    open_ = (root[rest] != root[i]) & (4 * np.minimum(n[rest], n[i]) >= 3 * np.maximum(n[rest], n[i]))
    open_ &= (np.abs(distance[rest] - distance[i]) <= 0.25 + 1e-9) | (distance[rest] < 0) | (distance[i] < 0)
    open_ &= (block[rest] != block[i]) | (block[i] < 0)
    return np.flatnonzero(open_) + i + 1


def _common(own: np.ndarray, starts: np.ndarray, sizes: np.ndarray, values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many of ``own`` (sorted) each of the ``others`` has."""
    at, owner = tx.ragged(starts[others], starts[others] + sizes[others])
    theirs = values[at]
    place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    return np.bincount(owner[own[place] == theirs], minlength=len(others))


def _with_partners(members: DataFrame) -> DataFrame:
    """Of the members of regions, with their leading shingles, those with a partner in their region that they may link to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region, r in _by_region(batches):
            n, lost, sizes = r["n"], r["lost"], r["leads"]
            starts, some = np.cumsum(sizes) - sizes, np.zeros(len(n), bool)
            behind = np.ceil(n * 0.75)
            for i in range(len(n) - 1):
                others = _others(i, r["root"], r)
                if not len(others) or not sizes[i]:
                    continue
                own = r["leading"][starts[i] : starts[i] + sizes[i]]
                shared = _common(own, starts, sizes, r["leading"], others) + np.minimum(lost[others], lost[i])
                needed = np.ceil((n[others] + n[i]) * 3 / 7)
                near = others[(shared > 0) & (shared + np.maximum(behind[others], behind[i]) - 1 >= needed)]
                some[near] = True
                some[i] |= len(near) > 0
            if some.any():
                names = ["class", "root", "n", "distance", "block"]
                columns = [np.full(int(some.sum()), region), *(r[c][some] for c in names)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["region", *names])

    rows = members.select(
        "region", "class", "root", "n", "distance", "block", F.col("lost").cast("long").alias("lost"),
        F.size("leading").cast("long").alias("leads"), F.array_sort("leading").alias("leading"),
    )
    schema = "region long, class long, root long, n long, distance double, block long"
    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, schema)


def _region_links(members: DataFrame) -> DataFrame:
    """a, b, common: links on whole sets that connect what is within 25 % distance in each region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, r in _by_region(batches):
            n, name, root, sets = r["n"], r["class"], r["root"].copy(), r["shingles"].view(np.uint64)
            starts, found = np.cumsum(n) - n, []
            for i in range(len(n) - 1):
                others = _others(i, root, r)
                if not len(others):
                    continue
                common = _common(sets[starts[i] : starts[i] + n[i]], starts, n, sets, others)
                linked = np.flatnonzero(175 * common >= 75 * (n[others] + n[i]))
                for k in linked.tolist():
                    j = others[k]
                    if root[j] != root[i]:
                        found.append((min(name[i], name[j]), max(name[i], name[j]), common[k]))
                        root[root == root[j]] = root[i]
            if found:
                a, b, common = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, common)], names=["a", "b", "common"])

    rows = members.select("region", "class", "root", "n", "distance", "block", "shingles")
    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(run, "a long, b long, common long")


def _sizes_fit(n: Column, m: Column) -> Column:
    return 4 * F.least(n, m) >= 3 * F.greatest(n, m)


def _prepared(documents: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame, _Comparison]:
    """Classes of the documents, postings of their leading shingles, a row per class that has some, and the comparison."""
    spark = documents.sparkSession
    told = stage(_classes(documents, k), "classes")
    classes = told.where("part IS NULL").select("doc_id", "text_hash", "n", "class")
    total = classes.agg(F.sum("n")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 4 * ENTRY.itemsize // PARTITION_BYTES))
    entries = _entries(documents, _levels(told), k, 8 * partitions)
    postings = stage(_postings(entries, partitions), "postings")
    # For the filter of pairs half of a shingle's bits do: a chance agreement only lets a pair through, and where
    # two shingles of a class agree, the bound on what it can share counts the one that was lost.
    half = F.shiftright("shingle", 32).cast("int")
    leading = postings.groupBy("class").agg(F.collect_set(half).alias("leading"), F.count(F.lit(1)).alias("n_leading"))
    one = classes.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash", "n")).alias("row"))
    signed = leading.join(one, "class").select("class", "leading", "n_leading", "row.*", *_signature(F.col("leading")))
    members = signed.withColumn("slack", F.col("n_leading") - sum(F.bit_count(c) for c in SIGNATURE))
    members = stage(members.withColumn("lost", F.col("n_leading") - F.size("leading")), "members")
    return classes, postings, members, _Comparison(documents, members, k)


def all_links(documents: DataFrame, k: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of the documents, all links between different classes, and how many links each class has.

    The first frame is that of ``jaccard_links``. The second has a, b, common:
    every pair a < b of classes with 100 * common >= 75 * union, connected or
    not; such a pair shares a leading shingle. The third has class and n_links,
    0 where there are none. As many rows as there are links: a group of n
    classes that are all alike has n * (n - 1) / 2.
    """
    classes, postings, members, compare = _prepared(documents, k)
    placed = postings.join(members.select("class", "n", "slack", *SIGNATURE), "class")
    p, y = placed.alias("p"), placed.alias("y")
    met = p.join(
        y,
        (F.col("p.shingle") == F.col("y.shingle"))
        & (F.col("p.class") < F.col("y.class"))
        & _sizes_fit(F.col("p.n"), F.col("y.n"))
        & _may_link(F.col("p.n"), F.col("y.n"), _most_common(p="p", y="y")),
    ).select(F.col("p.class").alias("a"), F.col("y.class").alias("b"))
    compared = compare(met)
    links = documents.sparkSession.createDataFrame([], "a long, b long, common long")
    if compared is not None:
        links = compared.where("linked").select("a", "b", "common")
    ends = links.select(F.col("a").alias("class")).unionAll(links.select(F.col("b").alias("class")))
    counts = ends.groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
    every = classes.where("class IS NOT NULL").select("class").distinct().join(counts, "class", "left")
    return classes, links, every.select("class", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_links(documents: DataFrame, k: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Classes of the documents, and links between classes that connect whatever is within 25 % distance.

    The first frame has doc_id, text_hash, n, class (null for an empty set). The
    second has a, b, common: pairs of classes with 100 * common >= 75 * union.
    Pairs whose classes were connected before they met are not listed; ``all_links``
    has every pair.
    """
    spark = documents.sparkSession
    classes, postings, members, compare = _prepared(documents, k)
    # Whoever shares most of its leading shingles lies in the middle of its copies: the better pivot.
    merit = F.col("n_leading") / (F.col("n") - F.ceil(F.col("n") * 0.75) + 1)
    ranked = members.select("class", F.col("n").cast("int").alias("n"), (-1000 * F.least(merit, F.lit(1.0))).cast("int").alias("merit"))

    # First round: one pivot for each region, its centre.
    placed = stage(postings.join(ranked, "class"), "placed")
    centre = placed.groupBy("shingle").agg(
        F.min(F.struct("merit", F.xxhash64("class").alias("by"), "class", "n")).alias("c"), F.count(F.lit(1)).alias("size")
    )
    around = placed.join(centre.select("shingle", F.col("c.class").alias("home"), F.col("c.n").alias("home_n"), "size"), "shingle")
    around = around.where(F.col("class") != F.col("home"))
    met = around.where(_sizes_fit(F.col("n"), F.col("home_n"))).select(F.col("home").alias("a"), F.col("class").alias("b"))
    compared = compare(met)
    links = spark.createDataFrame([], "a long, b long, common long")
    known = spark.createDataFrame([], "home long, class long, distance double")
    if compared is not None:
        links = compared.where("linked").select("a", "b", "common")
        known = compared.select(F.col("a").alias("home"), F.col("b").alias("class"), "distance")
    roots = stage(components(links), "roots")
    # Regions with one centre are one from here on; those of two members are done.
    live = around.where("size > 2").select("home", "class", "n", "merit").distinct().join(known, ["home", "class"], "left")

    # Regions whose members are not all connected yet are joined by themselves, each in its task.
    rooted = live.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    open_ = stage(_open_regions(stage(rooted.select("home", "class", "root", "n", "distance"), "rooted")), "regions")
    leading = members.select("class", "leading", "lost")
    partnered = stage(_with_partners(open_.join(leading, "class")), "partnered")
    sets = compare.sets_for(partnered.select("class"))
    if sets is not None:
        late = stage(_region_links(partnered.join(sets, "class")).distinct(), "late")
        links = links.unionByName(late)
    return classes, links


def _grouped(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n, class of every document, the component of its class and the smallest id in it."""
    classes, links = jaccard_links(documents, k)
    roots = components(links)
    smallest = classes.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"))
    labelled = smallest.join(roots.withColumnRenamed("node", "class"), "class", "left")
    grouped = labelled.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("group_first"))
    group_id = labelled.join(grouped, "root", "left").select(
        F.col("class").alias("known"), F.coalesce("root", "class").alias("root"), F.coalesce("group_first", "first").alias("group_id")
    )
    return classes.join(group_id, F.col("class") == F.col("known"), "left").drop("known")


def near_duplicates(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id: groups of documents linked by a similarity of 0.75 or more.

    ``documents`` has doc_id and text; other columns are ignored. Shingles are
    sets of k neighbouring words; a text with fewer words is one shingle, a null
    text or one without words has none and is linked with nothing (its
    component is its own id). component_id is the smallest doc_id that links
    reach; null ids are passed over unless a group has no other. Equal texts
    are one class from the start, so a group of copies costs no more than one
    of them. One row per row of ``documents``, repeated rows included.
    """
    return _grouped(documents, k).select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("component_id"),
    )


def keep_one(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``documents`` with one row of each group of near duplicates: that of the smallest doc_id, then hash of the text.

    Rows with a null doc_id come last. Rows without words are all kept. Of
    repeated rows (equal doc_id and text) one stays; columns stay as they are.
    """
    report = stage(_grouped(documents, k).where("class IS NOT NULL").select("doc_id", "text_hash", "root"), "groups")
    first = report.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("kept"))
    placed = report.join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))
    dropped = placed.where(~stays).select(F.col("doc_id").alias("__drop_id"), F.col("text_hash").alias("__drop_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__drop_id")) & (F.xxhash64("text") == F.col("__drop_hash"))
    kept = documents.join(dropped, same, "left_anti")
    if report.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        full = kept.withColumn("__has_words", F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
        kept = full.where("__has_words").dropDuplicates(["doc_id", "text"]).unionByName(full.where("NOT __has_words"))
        kept = kept.drop("__has_words")
    return kept
