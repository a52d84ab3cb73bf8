"""Chat formatting of reply trees, in DataFrame functions only.

A table of messages with parent links is a forest. Paths from a root to a leaf
are found by self-joins that double the length of the known links, so a thread
of n messages takes log2(n) joins. Leaves are ranked per tree by the mean score
of their path, and each chosen path becomes one text of marked turns.

Template: ``<|start|>ROLE\\nTEXT<|end|>\\n`` per turn. Inside roles and texts a
backslash is doubled and the first character of a control string (``<`` of
``<|``, ``<s>``, ``</s>``; ``[`` of ``[INST]``, ``[/INST]``) becomes ``\\l`` or
``\\b``, so no control string is left in them and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.session import stage

START, END = "<|start|>", "<|end|>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angles = F.regexp_replace(doubled, r"<(\||/?s>)", r"\\l$1")
    return F.regexp_replace(angles, r"\[(/?INST\])", r"\\b$1")


def unescape(text: Column) -> Column:
    """Left to right: a pair of backslashes is one, ``\\l`` is ``<``, ``\\b`` is ``[``."""
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda part: F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")),
    )
    return F.array_join(parts, "\\")


def escape_role(role: Column) -> Column:
    """A role is one line: a line feed inside becomes ``\\n``, which texts never hold after a single backslash."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(parts, "\\\\"))


def root_to_leaf_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, leaf, branch, node, depth: the messages on the chosen paths, depth 0 at the root.

    ``messages`` has tree, node, parent and score; a node is unique in its tree.
    A parent that is null or absent from the tree makes a root. A null score
    counts as 0. Leaves are ranked by mean score of their path (higher first),
    then by leaf; ``branches`` keeps the best so many per tree, None all.
    Messages on a cycle have no root and give no path. Trees may be null.
    """
    nodes = messages.select(
        "tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    )
    known = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    same_tree = F.col("tree").eqNullSafe(F.col("_t"))
    links = nodes.join(known, same_tree & (F.col("parent") == F.col("_n")), "left").select(
        "tree", "node", F.col("_n").alias("up"), "score", F.lit(1).cast("long").alias("length")
    )
    links = stage(links, "links")
    jumps = [links]
    # up: the ancestor 2 ** i links above, null beyond the root; score, length: of the path from the node to below it.
    while jumps[-1].where("up IS NOT NULL").limit(1).count():
        if 2 ** len(jumps) > 2 * links.count():
            break  # only cycles are left
        here = jumps[-1]
        above = here.select(
            F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"),
            F.col("score").alias("_score"), F.col("length").alias("_length"),
        )
        # Nodes whose path has reached its root are finished and not joined again.
        doubled = here.where("up IS NOT NULL").join(above, same_tree & (F.col("up") == F.col("_n"))).select(
            "tree",
            "node",
            F.col("_up").alias("up"),
            (F.col("score") + F.col("_score")).alias("score"),
            (F.col("length") + F.col("_length")).alias("length"),
        )
        jumps.append(stage(doubled.unionByName(here.where("up IS NULL")), "links"))
    rooted = jumps[-1].where("up IS NULL")
    parents = links.where("up IS NOT NULL").select(F.col("tree").alias("_t"), F.col("up").alias("_n")).distinct()
    leaves = rooted.join(parents, same_tree & (F.col("node") == F.col("_n")), "left_anti")
    best = Window.partitionBy("tree").orderBy((F.col("score") / F.col("length")).desc(), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(best))
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    members = chosen.select("tree", F.col("node").alias("leaf"), "branch", "node")
    for jump in jumps[:-1]:
        step = jump.where("up IS NOT NULL").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "up")
        reached = members.join(step, same_tree & (F.col("node") == F.col("_n"))).select(
            "tree", "leaf", "branch", F.col("up").alias("node")
        )
        members = stage(members.unionByName(reached), "members")
    depth = rooted.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), (F.col("length") - 1).alias("depth"))
    return members.join(depth, same_tree & (F.col("node") == F.col("_n"))).select("tree", "leaf", "branch", "node", "depth")


def format_paths(turns: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per conversation: ``keys``, formatted, loss_spans.

    ``turns`` has the keys, the order columns, role and text, a row per turn;
    null text and null role count as empty. ``loss_spans`` lists (start, length)
    in code points of the escaped assistant texts. A conversation is one value
    of the result, so its turns meet in one group; nothing else is gathered.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(*order, escape_role(role).alias("role"), escape(text).alias("text"))
    gathered = turns.groupBy(*keys).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    before = F.transform("_turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n")))
    sizes = F.transform(
        F.arrays_zip(before.alias("head"), F.col("_turns").alias("turn")),
        lambda z: F.struct(
            F.length(z["head"]).cast("long").alias("head"),
            F.length(z["turn"]["text"]).cast("long").alias("body"),
            (z["turn"]["role"] == "assistant").alias("counts"),
        ),
    )
    state = F.struct(F.lit(0).cast("long").alias("at"), F.expr("array()").cast("array<struct<start:long,length:long>>").alias("spans"))
    spans = F.aggregate(
        sizes,
        state,
        lambda acc, s: F.struct(
            (acc["at"] + s["head"] + s["body"] + len(END)).alias("at"),
            F.when(
                s["counts"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["head"]).alias("start"), s["body"].alias("length")))),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    formatted = F.array_join(
        F.transform("_turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), ""
    )
    return gathered.select(*keys, formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    pieces = F.split(formatted, r"<\|end\|>\n")
    complete = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last mark
    bodies = F.transform(complete, lambda p: F.substring(p, len(START) + 1, 2**31 - 1))
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.regexp_replace(b, r"\A[^\n]*\n", "")).alias("text"),
        ),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))),
        "",
    )


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """tree, leaf, branch, formatted, loss_spans for reply trees: tree, node, parent, score, role, text.

    Messages that repeat a (tree, node) are one message; which of them is kept
    is decided by parent, role and text, smallest first. An empty table gives no rows.
    """
    unique = messages.groupBy("tree", "node").agg(
        F.min(F.struct("parent", "role", "text", "score")).alias("_m")
    ).select("tree", "node", "_m.*")
    kept = stage(unique, "messages")
    paths = root_to_leaf_paths(kept, branches)
    told = kept.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "role", "text")
    turns = paths.join(told, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))
    return format_paths(turns, ["tree", "leaf", "branch"], ["depth"])


def linear_threads(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees in which each turn replies to the one before.

    Turns are ordered by turn (null first), then role and text, so rows with
    equal turns have a defined order and repeated rows stay turns of their own.
    """
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(place).cast("long"))
    return numbered.select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )
