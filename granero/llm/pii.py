"""Personal data: base patterns, generous candidate spans, gradient-boosted trees over their features.

All of it is DataFrame functions. Base patterns with their checks (digits, Luhn,
octets) give spans that always stay. Wider patterns propose candidates, which
may overlap each other and the base spans. Boosted trees learn from format and
context which candidates look like base spans of their kind: split statistics
are sums per (node, feature, value) over all candidates of the table, the trees
become CASE expressions. Per kind the smallest threshold that keeps ``PRECISION``
on a fifth of the texts set aside selects the candidates that are added.

Base patterns are written so that a match attempt never goes over a run of
characters twice: quantifiers are possessive where nothing could be given back,
and runs are entered at their first character or behind the match before.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.session import stage

KINDS = ["email", "ip", "card", "phone"]
TREES = 8
RATE = 0.5
SHRINK = 1.0
PRECISION = 0.95
CONTEXT = 24

_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
_LABEL = r"[A-Za-z0-9-]++"
BASE = {
    "email": rf"{_LOCAL}@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
CANDIDATES = {
    "email": rf"{_LOCAL}(?:@{_LABEL}(?:\.{_LABEL})*+"
    rf"|\s?[\[(]\s?at\s?[\])]\s?{_LABEL}(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?){_LABEL})++"
    rf"| at {_LABEL}(?: dot {_LABEL})++)",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\s?(?:\.|,|\[\.\]|\(\.\)|\[dot\]|\(dot\)| dot )\s?[0-9]{1,3}+(?![0-9])){3}",
    "card": r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,}+",
    "phone": r"(?<![0-9])(?:\+\s?|\()?[0-9](?:[ ()./-]{0,3}[0-9]){6,}+",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Words that announce a kind, looked for in the text just before a candidate.
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|from)\b",
    "card": r"(?i)\b(?:card|visa|credit|pay|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
}
#: Features of a candidate and their largest value; all are small whole numbers.
FEATURES = {
    "kind_no": 3, "n_digits": 20, "n_groups": 7, "longest": 20, "first_group": 8, "n_letters": 20, "n_labels": 6, "spaces": 4,
    "dashes": 4, "dots": 4, "parens": 2, "odd": 4, "luhn": 1, "octets": 1, "left": 3, "right": 3, "cue": 4,
}


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return F.length(_digits(found)).between(16, 19) & F.call_function("luhn_check", _digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str, possible: Column, keep) -> Column:
    """array of (start, end, found, before, after): matches that ``keep`` accepts, from left to right, in code points.

    ``split`` and ``regexp_extract_all`` walk the same matches; the lengths of
    the pieces between them give the positions. Only accepted matches are
    gathered, so a text of many short numbers stays cheap.
    """
    found = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    pieces = F.when(F.size(found) > 0, F.split(text, pattern)).otherwise(F.array().cast("array<string>"))
    kind = "array<struct<start:long,end:long,found:string,before:string,after:string>>"
    zipped = F.arrays_zip(
        found.alias("found"), F.slice(pieces, 1, F.size(found)).alias("piece"), F.slice(pieces, 2, F.greatest(F.size(found), F.lit(0))).alias("next")
    )

    def step(acc, z):
        start = acc["at"] + F.length(z["piece"])
        end = start + F.length(z["found"])
        one = F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"), z["found"].alias("found"),
            F.right(z["piece"], F.lit(CONTEXT)).alias("before"), F.left(z["next"], F.lit(1)).alias("after"),
        )
        spans = F.when(keep(z["found"]), F.concat(acc["spans"], F.array(one))).otherwise(acc["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("spans"))
    folded = F.aggregate(zipped, state, step, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, folded).otherwise(F.array().cast(kind))


def _edge(character: Column) -> Column:
    """0 end of the text, 1 blank, 2 mark, 3 letter or digit."""
    return (
        F.when(character == "", 0).when(character.rlike(r"\s"), 1).when(character.rlike(r"[\p{L}\p{N}]"), 3).otherwise(2)
    )


def _features(kind: str, m: Column) -> list[Column]:
    found, digits = m["found"], _digits(m["found"])
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    count = lambda pattern: F.size(F.split(found, pattern)) - 1
    cue = F.coalesce(*[F.when(m["before"].rlike(pattern), i + 1) for i, pattern in enumerate(CUES.values())], F.lit(0))
    values = {
        "kind_no": F.lit(KINDS.index(kind)),
        "n_digits": F.length(digits),
        "n_groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "first_group": F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        "n_letters": F.length(F.regexp_replace(found, "[^A-Za-z]", "")),
        "n_labels": count(r"\.|dot"),
        "spaces": count(" "),
        "dashes": count("-"),
        "dots": count(r"\."),
        "parens": count(r"\("),
        "odd": count(r"[\[\]/,]"),
        "luhn": F.coalesce(F.call_function("luhn_check", F.when(digits != "", digits)), F.lit(False)).cast("int"),
        "octets": found.rlike(rf"\A{_OCTET}(?:[^0-9]+{_OCTET}){{3}}\z").cast("int"),
        "left": _edge(F.right(m["before"], F.lit(1))),
        "right": _edge(m["after"]),
        "cue": cue,
    }
    return [F.least(values[name], F.lit(most)).cast("int").alias(name) for name, most in FEATURES.items()]


def spans_of(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, base, candidates for every document.

    ``base`` has (kind, start, end) by kind and start; ``candidates`` also has
    the features and whether the candidate meets a base span of its kind (near)
    or of any kind (taken).
    """
    text = F.coalesce("text", F.lit(""))
    has_digit = text.rlike("[0-9]")
    has_at = F.contains(text, F.lit("@"))
    spelled = text.rlike(r"at\s?[\])]") | F.contains(text, F.lit(" dot "))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text.alias("text"),
        has_digit.alias("has_digit"), has_at.alias("has_at"), spelled.alias("spelled"),
    )
    possible = {"email": F.col("has_at"), "ip": F.col("has_digit"), "card": F.col("has_digit"), "phone": F.col("has_digit")}
    proposed = {**possible, "email": F.col("has_at") | F.col("spelled")}
    rows = rows.select(
        "doc_id",
        "text_hash",
        *[_matches(F.col("text"), BASE[k], possible[k], partial(_valid, k)).alias(f"base_{k}") for k in KINDS],
        *[_matches(F.col("text"), CANDIDATES[k], proposed[k], lambda found: F.lit(True)).alias(f"more_{k}") for k in KINDS],
    )

    def checked(kind):
        return F.transform(
            f"base_{kind}", lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
        )

    rows = rows.select("doc_id", "text_hash", F.concat(*[checked(k) for k in KINDS]).alias("base"), *[f"more_{k}" for k in KINDS])

    def described(kind):
        def one(m):
            meets = lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"])
            return F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                F.exists("base", lambda b: (b["kind"] == kind) & meets(b)).alias("near"),
                F.exists("base", meets).alias("taken"),
                *_features(kind, m),
            )

        return F.transform(f"more_{kind}", one)

    return rows.select("doc_id", "text_hash", "base", F.concat(*[described(k) for k in KINDS]).alias("candidates"))


def _passes() -> Column:
    """Whether a candidate fulfils what its kind is checked for; without a base span to meet it may be data in a form of its own."""
    checks = {
        "email": (F.col("n_labels") > 0) & (F.col("cue") == 1 + KINDS.index("email")),
        "ip": F.col("octets") == 1,
        "card": F.col("n_digits").between(16, 19) & (F.col("luhn") == 1),
        "phone": F.col("n_digits").between(8, 15) & (F.col("cue") == 1 + KINDS.index("phone")),
    }
    return F.coalesce(*[F.when(F.col("kind_no") == KINDS.index(kind), check) for kind, check in checks.items()], F.lit(False))


def _leaf(g: float, h: float) -> float:
    return -RATE * g / (h + SHRINK)


def _tree(tree, value) -> Column:
    """A tree as an expression; ``value`` gives the column of a feature."""
    if isinstance(tree, float):
        return F.lit(tree)
    name, most, low, high = tree
    return F.when(value(name) <= most, _tree(low, value)).otherwise(_tree(high, value))


def _raw(start: float, trees: list, value) -> Column:
    total = F.lit(start)
    for tree in trees:
        total = total + _tree(tree, value)
    return total


def _probability(start: float, trees: list, value) -> Column:
    return 1 / (1 + F.exp(-_raw(start, trees, value)))


def _best_splits(rows: DataFrame, node: Column, p: Column) -> dict:
    """node -> (feature, threshold, G and H left, G and H right) of the largest gain; sums come from the table, FEATURES x values of them."""
    long = rows.select(
        node.alias("node"), (p * F.col("n") - F.col("positive")).alias("g"), (p * (1 - p) * F.col("n")).alias("h"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), F.col(name).alias("value")) for name in FEATURES])).alias("f"),
    )
    sums = long.groupBy("node", "f.feature", "f.value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
    best: dict = {}
    by: dict = {}
    for r in sums:
        by.setdefault((r["node"], r["feature"]), []).append((r["value"], r["g"], r["h"]))
    for (at, feature), values in sorted(by.items()):
        values.sort()
        g_all, h_all = sum(v[1] for v in values), sum(v[2] for v in values)
        g = h = 0.0
        for value, dg, dh in values[:-1]:
            g, h = g + dg, h + dh
            gain = g * g / (h + SHRINK) + (g_all - g) ** 2 / (h_all - h + SHRINK) - g_all**2 / (h_all + SHRINK)
            if gain > best.get(at, (1e-6,))[0] + 1e-9:
                best[at] = (gain, feature, value, (g, h), (g_all - g, h_all - h))
        best.setdefault(at, (0.0, None, None, (g_all, h_all), None))
    return best


def boost(rows: DataFrame, trees: int = TREES) -> tuple[float, list]:
    """Start value and depth-two trees from rows of features with n and positive."""
    n, positive = rows.agg(F.sum("n"), F.sum("positive")).first()
    if not n or not positive or positive == n:
        return (-20.0 if not positive else 20.0), []
    start, made = math.log(positive / (n - positive)), []
    for _ in range(trees):
        p = _probability(start, made, F.col)
        top = _best_splits(rows, F.lit(0), p)[0]
        if top[1] is None:
            break
        _, feature, most, low, high = top
        below = _best_splits(rows, F.when(F.col(feature) <= most, 1).otherwise(2), p)

        def grown(node, sums, below=below):
            split = below.get(node, (0, None))
            if split[1] is None:
                return _leaf(*sums)
            return (split[1], split[2], _leaf(*split[3]), _leaf(*split[4]))

        made.append((feature, most, grown(1, low), grown(2, high)))
    return start, made


def thresholds(rows: DataFrame, start: float, trees: list, precision: float = PRECISION) -> dict[str, float]:
    """Per kind the smallest score (in hundredths) that keeps ``precision`` from there up; above 1 where none does."""
    score = F.floor(_probability(start, trees, F.col) * 100).cast("int")
    sums = rows.groupBy("kind_no", score.alias("score")).agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).collect()
    chosen = {}
    for i, kind in enumerate(KINDS):
        n = positive = 0
        chosen[kind] = 2.0
        for r in sorted((r for r in sums if r["kind_no"] == i), key=lambda r: -r["score"]):
            n, positive = n + r["n"], positive + r["positive"]
            if positive >= precision * n:
                chosen[kind] = r["score"] / 100
    return chosen


def find(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, text_hash, base, spans: base spans and all spans (kind, start, end), by kind and start.

    Positions are code points, ends exclusive. Null and empty texts have no
    spans. One row per row of ``documents`` (doc_id, text); equal texts get
    equal spans, other columns are ignored. A candidate that meets a base span
    is not added. Of the others those that pass the check of their kind are no
    examples of anything; the rest are the negatives. With no base span at all
    nothing is learned or added.
    """
    found = stage(spans_of(documents), "spans")
    names = list(FEATURES)
    each = found.select((F.pmod("text_hash", F.lit(5)) == 0).alias("aside"), F.explode("candidates").alias("c")).select(
        "aside", F.col("c.near").alias("near"), *[F.col(f"c.{name}").alias(name) for name in names]
    )
    each = each.where(F.col("near") | ~_passes())
    table = each.groupBy("aside", *names).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("near").cast("long")).alias("positive"))
    table = stage(table, "features")
    start, trees = boost(table.where("NOT aside"))
    least = thresholds(table.where("aside"), start, trees, precision)
    chosen = F.filter(
        "candidates",
        lambda c: ~c["taken"]
        & (
            _probability(start, trees, lambda name: c[name])
            >= F.coalesce(*[F.when(c["kind"] == kind, value) for kind, value in least.items()], F.lit(2.0))
        ),
    )
    added = F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    rank = F.transform(
        F.concat("base", added),
        lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("no"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    spans = F.transform(F.array_sort(rank), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", "text_hash", "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(documents: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``documents`` with every span replaced by its kind in angle brackets; overlapping spans become one, named after the first.

    Other columns and rows stay as they are; a null text stays null.
    """
    found = find(documents, precision).dropDuplicates(["doc_id", "text_hash"])
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    marks = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias("__pii_id"), F.col("text_hash").alias("__pii_hash"), ordered.alias("__pii_spans")
    )
    joined = documents.join(
        marks, F.col("doc_id").cast("long").eqNullSafe(F.col("__pii_id")) & (F.xxhash64("text") == F.col("__pii_hash")), "left"
    )
    text = F.col("text")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], kept, F.lit("<"), s["kind"], F.lit(">"))).otherwise(acc["out"]).alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    cleaned = F.when(F.col("__pii_spans").isNull(), text).otherwise(F.aggregate("__pii_spans", state, step, rest))
    return joined.select(*[cleaned.alias("text") if c == "text" else F.col(c) for c in documents.columns])
