import re

import pytest

from granero.llm import pii
from tests.conftest import plan

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    "a@b.com_foo@bar.com x@y z@.com a.b+c%d@e-f.g.h.", "@@ a@b@c.d.e a@b..c a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.004 1.2.3 9.9.9.9999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111", "4111111111111111 4111111111111111", "12 3-4 5", "5500005555555559.",
    "+1 (216) 555-1361 oner +12 +1234567 +12345678 +1.2.3.4.5.6.7.8.9+49 (0)30 1234567", "++1 23-45 6789 0", "🙂🙂 me@site.org é 10.0.0.1",
    None, "", " ", "7" * 300, "a" * 5000 + "@" + "b" * 5000, "x." * 3000 + "@" + "d." * 6000 + "e", "1" + " 1" * 8000, "+1" + " " * 5000 + "2",
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def many(docs):
    """Enough base spans to learn from, and unmarked phones in the same form."""
    rows = [(i, f"word call +1 ({200 + i}) 555-{1000 + i} now, count {i} of {i + 3}.") for i in range(80)]
    rows += [(100 + i, f"word call ({200 + i}) 555-{1000 + i} now") for i in range(5)]
    rows += [(200 + i, f"in {1900 + i} there were {i * 7919 % 99991} and {i}-{i + 1} items, section 1.{i}.2") for i in range(80)]
    return docs(rows + [(300 + i, t) for i, t in enumerate(HARD)])


def test_base_spans_equal_brute_force(many):
    got = {r["doc_id"]: r for r in pii.find(many).collect()}
    texts = {r["doc_id"]: r["text"] for r in many.collect()}
    assert len(got) == len(texts)
    order = pii.KINDS.index
    for i, text in texts.items():
        assert [tuple(s) for s in got[i]["base"]] == brute(text), text
        spans = [tuple(s) for s in got[i]["spans"]]
        assert set(brute(text)) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (order(s[0]), s[1]))
    assert not any(got[i]["spans"] for i in range(200, 280))


def test_boosting_and_thresholds(spark):
    """Trees find the two features that matter; the threshold keeps its precision on rows set aside."""
    rows = []
    for digits in range(1, 20):
        for dashes in range(4):
            for near in range(2):
                wanted = digits > 10 and dashes >= 2
                values = {name: 0 for name in pii.FEATURES} | {"kind_no": 3, "n_digits": digits, "dashes": dashes}
                n = 90 if wanted == bool(near) else 10
                rows.append((*values.values(), n, n * near))
    schema = ", ".join(f"{name} int" for name in pii.FEATURES) + ", n long, positive long"
    table = spark.createDataFrame(rows, schema)
    start, trees = pii.boost(table)
    score = pii._probability(start, trees, lambda name: table[name])
    got = {(r["n_digits"], r["dashes"]): r["p"] for r in table.select("n_digits", "dashes", score.alias("p")).collect()}
    for (digits, dashes), p in got.items():
        assert (p > 0.5) == (digits > 10 and dashes >= 2), (digits, dashes, p)
    least = pii.thresholds(table, start, trees, 0.85)
    assert 0.5 < least["phone"] <= max(got.values()) and least["email"] > 1
    assert pii.thresholds(table, start, trees, 0.99)["phone"] > 1


def test_redaction(docs):
    frame = docs([(1, "mail a@b.com or 10.0.0.1."), (2, "none"), (3, None), (3, None)])
    got = sorted((r["doc_id"], r["text"]) for r in pii.redact(frame).select("doc_id", "text").collect() if r["text"])
    assert got == [(1, "mail <email> or <ip>."), (2, "none")]
    assert pii.redact(frame).count() == 4 and pii.redact(frame).columns == frame.columns


def test_odd_rows_empty_table_and_plan(odd):
    got = pii.find(odd)
    assert got.count() == odd.count() and all(not r["spans"] for r in got.collect())
    assert pii.find(odd.limit(0)).count() == 0
    for unwanted in ("Python", "Arrow", "Pandas"):
        assert unwanted not in plan(pii.spans_of(odd), "simple")


def test_forms_of_their_own_are_added(docs):
    rows = [(i, f"pay by card 4111 1111 1111 1111 or 5500-0055-5555-5559, case {i}, order 1234 5678 9012 {1000 + i}") for i in range(60)]
    rows += [(100 + i, f"pay by card 4111.1111.1111.1111 now, case {i}") for i in range(60)]
    rows += [(200, "reach me: joe [ at ] site.org thanks")]
    got = {r["doc_id"]: r for r in pii.find(docs(rows)).collect()}
    assert all([tuple(s) for s in got[100 + i]["spans"]] == [("card", 12, 31)] for i in range(60))
    assert all(got[i]["spans"] == got[i]["base"] for i in range(60))  # numbers that fail the check stay out
    candidates = pii.spans_of(docs(rows[-1:])).first()["candidates"]
    assert [(c["kind"], c["start"], c["end"]) for c in candidates] == [("email", 10, 29)]
