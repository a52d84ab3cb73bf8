"""Repair of conversation structure: the cheapest edits that give ``(system? (user assistant)+)?``.

A conversation is a signature, one sign per row (role initial and fault). What
an edit costs from a row on depends on the rest of the signature only, so all
conversations share their suffixes: distinct signatures are sorted by their
reversed text, and a task walks each range of them as a word graph from the end,
computing every suffix it meets once. Suffixes that cost every grammar state the
same, up to a constant, are one node of the automaton: there are a few dozen
such nodes whatever the input. A node and a sign give the edit of every grammar
state; following them from the start is the audit.

Texts are read by streams of sorted rows that hold one row at a time; of a
conversation a task holds its signature and its audit, a byte per row.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.session import stage

# Costs of the edits, and what a last character may be.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_FULL_STOP = r"[.!?][\x20\x09-\x0D]*\z"
_SOLID = r"[^\x20\x09-\x0D]"
# End of fixed values.

START, SYSTEM, USER, ASSISTANT = range(4)
_NEEDED = (USER, USER, ASSISTANT, USER)  # what may be inserted, or a row be made, in each state
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = ("su", "ua", "au")
#: Signs: role initials (o: any other) in lower case, in upper case when the text breaks off; x has to go.
GONE = "x"


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    return _NEEDED[state] if initial == "ua"[_NEEDED[state] == ASSISTANT] else None


class Automaton:
    """Nodes: cost-to-go of the four grammar states above their least; edges: a sign in front of what follows."""

    def __init__(self) -> None:
        self.costs = [(0, 2 * INSERT, INSERT, 0)]  # nothing follows
        self.ends = ("", "II", "I", "")
        self._ids = {self.costs[0]: 0}
        self._edges: dict[tuple[int, str], int] = {}
        self.edges: list[tuple[int, int, list[tuple[str, int]]]] = []  # node, added cost, per state edits and next state

    def edge(self, node: int, sign: str) -> int:
        """Number of the edge that ``sign`` makes in front of ``node``; made once."""
        if (node, sign) not in self._edges:
            self._edges[node, sign] = len(self.edges)
            self.edges.append(self._make(self.costs[node], sign))
        return self._edges[node, sign]

    def _make(self, after: tuple[int, ...], sign: str) -> tuple[int, int, list[tuple[str, int]]]:
        best: list[tuple[int, str, int]] = []  # cost, edit, next state; edits are tried in the order that breaks ties
        short = TRUNCATED if sign.isupper() else 0
        for state in range(4):
            options = [(DELETE + after[state], "D", state)]
            if sign != GONE:
                to = _kept(state, sign.lower())
                if to is not None:
                    options.append((KEEP + short + after[to], "K", to))
                options.append((REROLE + short + after[_NEEDED[state]], "R", _NEEDED[state]))
            best.append(min(options))
        moved = list(best)
        for _ in range(3):  # an insertion leads to another state before the same row
            moved = [min(best[s], (INSERT + moved[_NEEDED[s]][0], "I", _NEEDED[s])) for s in range(4)]
        plans = []
        for state in range(4):
            edits = ""
            while moved[state][1] == "I":
                edits, state = edits + "I", moved[state][2]
            plans.append((edits + moved[state][1], moved[state][2]))
        least = min(m[0] for m in moved)
        costs = tuple(m[0] - least for m in moved)
        node = self._ids.setdefault(costs, len(self.costs))
        if node == len(self.costs):
            self.costs.append(costs)
        return node, least, plans


class Walk:
    """Signatures in the order of their reversed text: each shares the nodes of the suffix it has in common with the last."""

    def __init__(self) -> None:
        self.automaton = Automaton()
        self.last = ""
        self.path, self.total = array("l"), array("q")  # per row from the end: edge, cost of the least state
        self.made = 0

    def __call__(self, turned: str) -> tuple[int, str]:
        """Cost and audit of a signature that is given from its end."""
        common = 0
        for a, b in zip(self.last, turned):  # noqa: B905
            if a != b:
                break
            common += 1
        del self.path[common:], self.total[common:]
        node = self.automaton.edges[self.path[-1]][0] if common else 0
        cost = self.total[-1] if common else 0
        for sign in turned[common:]:
            edge = self.automaton.edge(node, sign)
            node, added, _ = self.automaton.edges[edge]
            cost += added
            self.path.append(edge)
            self.total.append(cost)
            self.made += 1
        self.last = turned
        cost += self.automaton.costs[node][START]
        state, audit = START, []
        for edge in reversed(self.path):
            edits, state = self.automaton.edges[edge][2][state]
            audit.append(edits)
        return cost, "".join(audit) + self.automaton.ends[state]


def _row(turn: Column, role: Column, text: Column) -> list[Column]:
    """turn, role, key of the text: rows of a conversation are taken in this order, nulls first."""
    return [turn.cast("long").alias("turn"), role.alias("role"), F.unhex(F.sha2(text, 256)).alias("key")]


def _whole(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with planted faults, by a hash of conv_id and turn.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes full stops,
    exclamation and question marks, 3 repeats it, 4 makes it the user's. Nulls
    count as one space in role, text and in what is hashed. Repeated rows are
    damaged alike. Other columns are left out.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name) % 20
    whole = _whole(rows).withColumn("_kind", kind).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return whole.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _signs(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, key, sign, fault of every row, without its text.

    A row is a repetition when its role and text stand in an earlier row. The
    first place of a role and a text is a minimum that is combined before it
    moves; equal rows of one turn are counted, not listed.
    """
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    narrow = rows.select(
        "conv_id",
        *_row(F.col("turn"), F.col("role"), F.col("text")),
        kind.alias("initial"),
        F.col("text").rlike(_SOLID).alias("solid"),
        F.col("text").rlike(_FULL_STOP).alias("ended"),
    )
    counted = narrow.groupBy("conv_id", "turn", "role", "key").agg(
        F.first("initial").alias("initial"), F.first("solid").alias("solid"), F.first("ended").alias("ended"), F.count("*").alias("copies")
    )
    counted = stage(counted, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = counted.where("solid").groupBy("conv_id", "role", "key").agg(F.min(place).alias("first"))
    first = first.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    placed = counted.join(first, same, "left").withColumn("fresh", place.eqNullSafe(F.col("first")))
    head = F.when(~F.col("solid"), "b").when(~F.col("fresh"), "d").when(~F.col("ended"), "t").otherwise("k")
    return placed.select("conv_id", "turn", "role", "key", "initial", head.alias("head"), "copies")


_SIGNED = pa.schema(
    [("conv_id", pa.int64()), ("signature", pa.string())]
    + [(c, pa.int64()) for c in ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")]
)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows that are sorted by conversation and place."""
    done: list[tuple] = []
    current: list | None = None

    def close() -> None:
        if current is not None:
            conv, signs, low, high, turns, faults, illegal, _ = current
            done.append((conv, signs.decode(), low, high, turns, faults["b"], faults["d"], faults["t"], illegal))

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _SIGNED, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_SIGNED)

    for batch in batches:
        for conv, turn, initial, head, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current is None or current[0] != conv:
                close()
                current = [conv, bytearray(), None, None, 0, dict.fromkeys("bdtk", 0), 0, ""]
            _, signs, low, high, _, faults, _, before = current
            if turn is not None:
                current[2] = turn if low is None else low
                current[4] += turn != high
                current[3] = turn
            again = "b" if head == "b" else "d"
            faults[head] += 1
            faults[again] += copies - 1
            current[6] += (before != "" and before + initial not in _LEGAL) + (copies - 1)  # no role follows itself
            sign = GONE if head in "bd" else initial.upper() if head == "t" else initial
            signs += (sign + GONE * (copies - 1)).encode()
            current[7] = initial
        if len(done) >= 10_000:
            yield flush()
    close()
    if done:
        yield flush()


_AUDITS = "turned string, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk = Walk()
    for batch in batches:
        turned = batch.column(0).to_pylist()
        found = [walk(t) for t in turned]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            names=["turned", "cost", "audit"],
        )


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text) its faults and its cheapest repair.

    conv_id, signature, gaps, blank, duplicate, truncated, illegal, cost,
    audit. Rows are taken by turn, null turns first; rows of one turn by role
    and then by the digest of their text, copies one after the other. Null role
    and text count as one space, null ids as one conversation; a gap beyond 64
    bits is null. Other columns are ignored; without rows there is no result.
    """
    signs = _signs(_whole(rows))
    ordered = signs.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key")
    signed = ordered.select("conv_id", "turn", "initial", "head", "copies").mapInArrow(
        _signatures,
        "conv_id long, signature string, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long",
    )
    signed = stage(signed.withColumn("turned", F.reverse("signature")), "repair-signatures")
    distinct = stage(signed.select("turned").distinct(), "repair-distinct")
    walked = distinct.repartitionByRange("turned").sortWithinPartitions("turned").mapInArrow(_audits, _AUDITS)
    wide = "decimal(38,0)"
    gaps = (F.col("high").cast(wide) - F.col("low").cast(wide) + 1 - F.col("turns")).try_cast("long")
    gaps = F.when(F.col("low").isNull(), 0).otherwise(gaps).cast("long").alias("gaps")
    return signed.join(walked, "turned").select(
        "conv_id", "signature", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of what stays or comes new."""
    state, place = START, 0
    for role, text in rows:
        while audit[place] == "I":
            state, place = _NEEDED[state], place + 1
            yield "I", _ROLE[state], ""
        edit, place = audit[place], place + 1
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else _NEEDED[state]
            yield edit, role, text
        elif edit == "R":
            state = _NEEDED[state]
            yield edit, _ROLE[state], text
    for _ in audit[place:]:
        state = _NEEDED[state]
        yield "I", _ROLE[state], ""


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[tuple[str, str]]]]:
    """conv_id, audit and rows of each conversation, one row at a time; the rows have to be used up in turn."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    ahead = next(rows, None)

    def own() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[1] is None:
            yield ahead[2], ahead[3]
            ahead = next(rows, None)

    while ahead is not None:
        conv, audit = ahead[:2]
        ahead = next(rows, None)
        yield conv, audit, own()


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits and rows of each conversation next to each other, the audit in front."""
    whole = _whole(rows)
    texts = whole.select("conv_id", F.lit(None).cast("string").alias("audit"), *_row(F.col("turn"), F.col("role"), F.col("text")), "text")
    heads = found.select(
        "conv_id",
        "audit",
        F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast("string").alias("text"),
    )
    together = texts.unionByName(heads).withColumn("_row", F.col("audit").isNull())
    sort = together.repartition("conv_id").sortWithinPartitions("conv_id", "_row", "turn", "role", "key")
    return sort.select("conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role, text; ``found`` holds their audits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = ["conv_id", "place", "edit", "role", "text"], [], 0
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

        for conv, audit, own in _conversations(batches):
            for place, (edit, role, text) in enumerate(_edited(audit, own)):
                held.append((conv, place, edit, role, text))
                size += len(text) + 32
                if size > 1 << 22:
                    yield flush()
                    held, size = [], 0
            for _ in own:  # nothing is left when the audit fits the rows
                raise ValueError(f"the audit of conversation {conv} is not one of these rows")
        if held:
            yield flush()

    return _joined(rows, found).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the repaired ``role:text`` lines of each conversation, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums = [], []
        for conv, audit, own in _conversations(batches):
            told, line = hashlib.sha256(), ""
            for _, role, text in _edited(audit, own):
                told.update(f"{line}{role}:{text}".encode())
                line = "\n"
            ids.append(conv)
            sums.append(told.hexdigest())
            if len(ids) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])
                ids, sums = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])

    return _joined(rows, found).mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """:func:`audits` with the digest of each repaired conversation."""
    found = stage(audits(rows), "repair-audits")
    told = digests(rows, found).withColumnRenamed("conv_id", "_conv")
    return found.join(told, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
