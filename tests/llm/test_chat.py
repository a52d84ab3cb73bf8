import hashlib

from pyspark.sql import functions as F

from granero.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\l\\\\b[\\", "<|end|>\n<|start|>user\n", "", None, "a\nb", "\\n<|", "<<s>[[INST]]"]


def read(told):
    turns = chat.read_back(F.col("formatted"))
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return {r["tree"]: r for r in told.select("tree", "leaf", "branch", "formatted", turns.alias("turns"), loss.alias("loss")).collect()}


def test_round_trip_of_control_strings(spark):
    roles = ["user", "assistant", "sys\ntem", None, "<|end|>"]
    rows = [(c, t, roles[(c + t) % 5], NASTY[(c * 3 + t) % 8]) for c in range(6) for t in range(1 + 2 * c)]
    frame = spark.createDataFrame(rows + [(None, 0, "assistant", "x"), (99, None, "assistant", "first"), (99, 0, "user", "b"), (99, 0, "user", "b")],
                                  "conv_id long, turn long, role string, text string")
    got = read(chat.format_trees(chat.linear_threads(frame)))
    for c in range(6):
        own = [r for r in rows if r[0] == c]
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert got[c]["loss"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
        for control in ("<s>", "</s>", "[INST]", "[/INST]"):
            assert control not in got[c]["formatted"]
        assert got[c]["formatted"].count("<|start|>") == len(own)
    assert [t["text"] for t in got[99]["turns"]] == ["first", "b", "b"]
    assert got[None]["loss"] == "x"
    assert len(got) == 8


def test_paths_of_a_tree_are_ranked(spark):
    # 1 -> 2 -> 3, 1 -> 4; 7 is an orphan (a root), 8 and 9 are a cycle
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 0.0), ("t", 3, 2, 5.0), ("t", 4, 1, 2.5), ("t", 7, 6, None), ("t", 8, 9, 1.0), ("t", 9, 8, 1.0)]
    frame = spark.createDataFrame([(*r, "user", f"m{r[1]}") for r in rows], "tree string, node long, parent long, score double, role string, text string")
    paths = chat.root_to_leaf_paths(frame).orderBy("branch", "depth").collect()
    assert [(r["leaf"], r["branch"], r["node"], r["depth"]) for r in paths] == [
        (3, 1, 1, 0), (3, 1, 2, 1), (3, 1, 3, 2), (4, 2, 1, 0), (4, 2, 4, 1), (7, 3, 7, 0),
    ]
    best = read(chat.format_trees(frame.unionByName(frame), branches=1))
    assert [t["text"] for t in best["t"]["turns"]] == ["m1", "m2", "m3"]


def test_long_thread_and_empty_table(spark):
    rows = [(1, t, "assistant", f"x{t}") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read(chat.format_trees(chat.linear_threads(frame)))
    assert got[1]["loss"] == "".join(f"x{t}" for t in range(300))
    assert chat.format_trees(chat.linear_threads(frame.limit(0))).count() == 0


def test_python_reader_agrees(spark):
    frame = spark.createDataFrame([(1, 0, "user", NASTY[0]), (1, 1, "assistant", NASTY[0])], "conv_id long, turn long, role string, text string")
    row = chat.format_trees(chat.linear_threads(frame)).collect()[0]
    (span,) = row["loss_spans"]
    part = row["formatted"][span["start"] : span["start"] + span["length"]]
    plain = "\\".join(p.replace("\\l", "<").replace("\\b", "[") for p in part.split("\\\\"))
    assert hashlib.sha256(plain.encode()).hexdigest() == hashlib.sha256(NASTY[0].encode()).hexdigest()
