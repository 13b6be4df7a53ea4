"""Chat formatting of reply trees, with DataFrame functions only.

``nodes`` is a table of replies: tree, node, parent, role, text, score. A
branch is a path from a root to a leaf. The paths are found by iterative
self-joins that double the distance each time (a node learns its ancestor
1, 2, 4, ... steps up), so a thread of n turns takes log2(n) rounds and every
join is keyed by (tree, node): a tree with most of the rows is spread like
any other. Branches of a tree are ranked by the mean score of their nodes,
and each chosen branch becomes one formatted conversation.

Template, per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings
inside roles and texts are escaped by one backslash after their first
character; a string that already has backslashes there gets one more, so
removing one backslash undoes it exactly. Line feeds and backslashes of a
role are escaped as well.

Defined cases: null roles and texts are empty; a null tree is a tree of its
own; a node whose parent is missing is a root; rows that repeat a (tree,
node) count once, the smallest (parent, role, text) stays; nodes on a cycle
have no root and belong to no branch; ties between branches go to the
smaller leaf; an empty table gives no conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tellus.llm.common import text_or_empty, written

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
# The control strings of common chat templates, as a first
# character and what follows it.
_CONTROL = r"(\|im_(?:start|end)\|>|/?s>|</?SYS>>|/?INST\])"
ESCAPE = (r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")
UNESCAPE = (r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # an escaped backslash steps aside (NUL, b) while \n turns into a line feed
    r = F.replace(F.replace(unescape(role), F.lit("\0"), F.lit("\0a")), F.lit("\\\\"), F.lit("\0b"))
    r = F.replace(r, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(r, F.lit("\0b"), F.lit("\\")), F.lit("\0a"), F.lit("\0"))


def _key(col: Column) -> Column:
    """A non-null text key for any column."""
    return F.when(col.isNull(), "n").otherwise(F.concat(F.lit("v"), col.cast("string")))


def thread_nodes(rows: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Reply-tree nodes of linear threads: each turn replies to the one
    before. Turns are ordered by (turn, role, text), nulls first; equal rows
    stay separate turns. Score: 1 for a turn with text, else 0."""
    t = rows.select(F.col(tree_col).alias("tree"), F.col(turn_col).alias("turn"),
                    text_or_empty(F.col(role_col)).alias("role"), text_or_empty(F.col(text_col)).alias("text"))
    n = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    t = t.withColumn("node", n)
    return t.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                    (F.col("text") != "").cast("double").alias("score"))


def branches(nodes: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """Rows (tree, leaf, branch_rank, branch_score, pos, role, text): the
    turns of the chosen branches, pos from 0 at the root. ``per_tree`` best
    branches of each tree are chosen; None: all."""
    n = nodes.select("tree", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
                     text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text"),
                     F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    n = n.filter("node IS NOT NULL").withColumn("k", _key(F.col("tree")))
    n = n.groupBy("k", "node").agg(F.min(F.struct("parent", "role", "text", "score", "tree")).alias("r"))
    n = written(n.select("k", "node", "r.*"), "nodes")
    links = n.select("k", "node", "parent", "score")
    known = links.select("k", F.col("node").alias("parent"), F.lit(True).alias("known"))
    up = links.join(known, ["k", "parent"], "left").select(
        "k", "node", F.when(F.col("known"), F.col("parent")).alias("anc"), F.lit(1).cast("long").alias("dist"),
        F.col("score").alias("total"))
    up = written(up, "up")
    jumps, done, active = [], [up.filter("anc IS NULL")], up.filter("anc IS NOT NULL")
    state, left = up, active.count()
    while left:
        jumps.append(active.select("k", "node", F.col("anc").alias("to")))
        ahead = state.select("k", F.col("node").alias("anc"), F.col("anc").alias("anc2"),
                             F.col("dist").alias("dist2"), F.col("total").alias("total2"))
        active = active.join(ahead, ["k", "anc"]).select(
            "k", "node", F.col("anc2").alias("anc"), (F.col("dist") + F.col("dist2")).alias("dist"),
            (F.col("total") + F.col("total2")).alias("total"))
        state = written(active, "up")
        done.append(state.filter("anc IS NULL"))
        active = state.filter("anc IS NOT NULL")
        before, left = left, active.count()
        # an ancestor that is finished already lies in an earlier table
        state = state if not left else _union(done + [active])
        if left == before:  # only cycles go on for ever
            break
    reached = _union(done)
    parents = links.select("k", F.col("parent").alias("node")).filter("node IS NOT NULL")
    leaves = reached.join(parents, ["k", "node"], "left_anti").withColumn("branch_score", F.col("total") / F.col("dist"))
    rank = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("branch_score"), "node"))
    leaves = leaves.withColumn("branch_rank", rank)
    if per_tree is not None:
        leaves = leaves.filter(F.col("branch_rank") <= per_tree)
    path = leaves.select("k", F.col("node").alias("leaf"), "branch_rank", "branch_score",
                         (F.col("dist") - 1).alias("pos"), "node")
    path = written(path, "path")
    for i, jump in enumerate(jumps):
        further = path.join(jump, ["k", "node"]).select(
            "k", "leaf", "branch_rank", "branch_score", (F.col("pos") - 2 ** i).alias("pos"), F.col("to").alias("node"))
        path = written(path.unionByName(further), "path")
    return path.join(n, ["k", "node"]).select("tree", "k", "leaf", "branch_rank", "branch_score", "pos", "role", "text")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def format_branches(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per branch: tree, leaf, branch_rank, branch_score, formatted,
    loss_mask (array of (start, length) in code points of ``formatted``, one
    for each turn of ``loss_role``, in order)."""
    t = turns.withColumn("head", F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit("\n")))
    t = t.withColumn("body", escape(F.col("text")))
    w = Window.partitionBy("k", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(TURN_END)
    t = t.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(w), F.lit(0)) + F.length("head"))
    piece = F.struct("pos", F.concat("head", "body", F.lit(TURN_END)).alias("piece"), "start",
                     F.length("body").alias("length"), (F.col("role") == loss_role).alias("loss"))
    g = t.groupBy("k", "leaf").agg(F.first("tree").alias("tree"), F.first("branch_rank").alias("branch_rank"),
                                   F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(piece)).alias("p"))
    mask = F.transform(F.filter("p", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return g.select("tree", "leaf", "branch_rank", "branch_score",
                    F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), mask.alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> parsed back from a formatted conversation."""
    parts = F.split(formatted, r"\Q" + TURN_END + r"\E", -1)
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        inner = F.substr(p, F.lit(len(TURN_START) + 1))
        cut = F.instr(inner, "\n")
        return F.struct(unescape_role(F.substr(inner, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(inner, cut + 1)).alias("text"))
    return F.transform(parts, turn)


def read_loss(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(mask, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
