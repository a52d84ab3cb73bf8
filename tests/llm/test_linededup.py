import pytest

from granero.llm import linededup


def brute(rows, width=3):
    seen, out = set(), {}
    for i, text in sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (text or "").split("\n")
        gone = set()
        for s in range(max(len(lines) - width, 0) + 1):
            window = "\n".join(lines[s : s + width])
            if not window.strip():
                continue
            if window in seen:
                gone |= set(range(s, min(s + width, len(lines))))
            seen.add(window)
        out[i] = None if text is None else "\n".join(l for p, l in enumerate(lines) if p not in gone)
    return out


def cleaned(frame):
    return {r["doc_id"]: r["text"] for r in linededup.dedup_lines(frame).collect()}


def test_windows_equal_brute_force(docs):
    lines = [f"line {i}" for i in range(12)]
    rows = [
        (1, "\n".join(lines)),
        (2, "\n".join(["own a", *lines[3:8], "own b", "own c"])),
        (3, "\n".join([lines[0], "x", lines[1], "y", lines[2]])),  # no three in a row
        (4, "\n".join(lines)),
        (5, "\n".join(["r", "s", "t", "r", "s", "t", "u"])),  # repeats itself
        (6, "\n\n\n\n"),
        (7, "\n\n\n\nz"),
        (8, "short"),
        (9, "short"),
        (10, "two\nlines"),
        (11, "two\nlines"),
        (12, "two\nlines\nthree"),
        (13, "\n".join(["overlap", *lines[0:4], *lines[2:6]])),
    ]
    frame = docs(rows)
    assert cleaned(frame) == brute(rows)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["start"], r["h1"]) for r in linededup.dedup_lines(frame).collect()}
    assert got[4] == (12, 12, 5, "x") and got[2] == (8, 5, 5, "x")


def test_odd_rows_and_empty_table(odd):
    got = linededup.dedup_lines(odd).collect()
    assert len(got) == odd.count()
    texts = [(r["doc_id"], r["text"]) for r in got]
    assert (1, None) in texts and (2, "") in texts and (7, "") in texts and (6, "one") in texts
    assert [t for i, t in texts if i == 5] == ["", ""]  # copies of 4, cut alike
    assert linededup.dedup_lines(odd.limit(0)).count() == 0


@pytest.mark.parametrize("width", [1, 2])
def test_other_widths(docs, width):
    rows = [(1, "a\nb\nc"), (2, "b\nc\nd"), (3, "c")]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs(rows), width).collect()}
    assert got == brute(rows, width)
