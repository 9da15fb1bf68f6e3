"""Chat formatting over reply trees, in native columns.

Messages form trees by (conversation, node, parent). Joins of a message table with itself double
the reach in every step: after k of them each node knows its 2^k-th ancestor and the score of
the path so far, so a tree of depth d takes log2(d) joins. Leaves are ranked by the mean score
of their path, the best branches of each conversation are enumerated by the same jumps, and each
path becomes one formatted conversation.

The template marks a turn as ``<|role|>``, a line end, the text, a line end, ``<|end|>``, a line
end. Inside roles and texts each ``\\``, ``<`` and ``[`` is followed by a backslash, so no control
string can appear there, and ``unescape`` gives the text back. ``loss_spans`` are the code points
of assistant texts in ``formatted``.

Null texts and roles count as empty; a null conversation id is a conversation of its own. A node
whose parent is missing is a root. Of rows that repeat (conversation, node) the smallest by
(parent, score, role, text) counts. A cycle is an error of the input and stops the run. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

END = "\n<|end|>\n"
MAX_DOUBLINGS = 40  # beyond two to this power a path can only be a cycle


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def escape_role(role: Column) -> Column:
    """Bars as well, since one ends the mark of a turn."""
    return F.regexp_replace(role, r"([\\<\[|])", r"$1\\")


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\<\[|])\\", "$1")


def linear_tree(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns of linear conversations as trees: each row answers the one before it.

    Rows of equal turn follow each other by role and text.
    """
    order = Window.partitionBy(conv).orderBy(turn, role, text)
    return rows.select(
        F.col(conv).alias("conv_id"), F.row_number().over(order).cast("long").alias("node"), F.col(role).alias("role"), F.col(text).alias("text")
    ).select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _meets(node: str) -> Column:
    """Own conversation and ``node`` against the other side's ``c`` and ``at``."""
    return F.col("conv_id").eqNullSafe(F.col("c")) & (F.col(node) == F.col("at"))


def paths(tree: DataFrame, branches: int = 1) -> DataFrame:
    """``conv_id, leaf, branch, hop, node``: the nodes of the best branches, ``hop`` counted from the leaf."""
    links = written(tree.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "links")
    known = links.select(F.col("conv_id").alias("c"), F.col("node").alias("at"))
    # A parent that is not there makes its child a root.
    level = links.join(known, _meets("parent"), "left").select(
        "conv_id", "node", F.col("at").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")
    )
    # Nodes whose path has reached its root are done; only the others are looked up further.
    first = written(level, "jumps")
    done, going = first.filter("up is null"), first.filter("up is not null")
    jumps = []
    while going.head(1):
        if len(jumps) > MAX_DOUBLINGS:
            raise ValueError("the replies form a cycle")
        jumps.append(going)
        far = going.unionByName(done).select(
            F.col("conv_id").alias("c"), F.col("node").alias("at"), F.col("up").alias("further"), F.col("total").alias("more"), F.col("depth").alias("deeper")
        )
        doubled = going.join(far, _meets("up")).select(
            "conv_id", "node", F.col("further").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("deeper")).alias("depth")
        )
        level = written(doubled, "jumps")
        done, going = done.unionByName(level.filter("up is null")), level.filter("up is not null")
    answered = links.filter("parent is not null").select(F.col("conv_id").alias("c"), F.col("parent").alias("at")).distinct()
    leaves = done.join(answered, _meets("node"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("depth")), "node"))
    reached = leaves.select("conv_id", "node", rank.alias("branch")).filter(F.col("branch") <= branches).select(
        "conv_id", F.col("node").alias("leaf"), "branch", F.lit(0).cast("long").alias("hop"), "node"
    )
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("conv_id").alias("c"), F.col("node").alias("at"), "up")
        further = reached.join(step, _meets("node")).select(
            "conv_id", "leaf", "branch", (F.col("hop") + 2**k).alias("hop"), F.col("up").alias("node")
        )
        reached = written(reached.unionByName(further), "paths")
    return reached


def one_per_node(tree: DataFrame) -> DataFrame:
    """One row of each (conversation, node), and no other columns than those of a tree."""
    own = F.struct("parent", "score", "role", "text")
    return tree.groupBy("conv_id", "node").agg(F.min(own).alias("own")).select("conv_id", "node", "own.*")


def format_paths(tree: DataFrame, branches: int = 1, unique: bool = False) -> DataFrame:
    """``conv_id, leaf, branch, n_turns, formatted, loss_spans``: one row per chosen path.

    ``loss_spans``: array of (turn from 0, start, end) in code points of ``formatted``.
    ``unique``: no (conversation, node) is repeated, as in what ``linear_tree`` gives.
    """
    tree = tree if unique else written(one_per_node(tree), "nodes")
    nodes = paths(tree, branches)
    words = tree.select(F.col("conv_id").alias("c"), F.col("node").alias("at"), F.coalesce("role", F.lit("")).alias("role"), text_of(F.col("text")).alias("text"))
    turns = nodes.join(words, _meets("node")).select(
        "conv_id", "leaf", "branch", "hop", "role",
        F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>\n")).alias("head"), escape(F.col("text")).alias("said"),
    )
    path = Window.partitionBy("conv_id", "leaf").orderBy(F.desc("hop"))
    size = F.length("head") + F.length("said") + len(END)
    placed = turns.withColumn("turn", F.row_number().over(path) - 1).withColumn(
        "end", F.sum(size.cast("long")).over(path.rowsBetween(Window.unboundedPreceding, 0)) - len(END)
    ).withColumn("start", F.col("end") - F.length("said"))
    gathered = placed.groupBy("conv_id", "leaf", "branch").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.concat("head", "said", F.lit(END)).alias("piece"), "start", "end", (F.col("role") == "assistant").alias("learn")))).alias("t")
    )
    return gathered.select(
        "conv_id", "leaf", "branch", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(x["turn"].alias("turn"), x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array of (role, text), unescaped."""
    pieces = F.split(formatted, r"\n<\|end\|>\n")
    return F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescape_role(F.regexp_extract(p, r"(?s)\A<\|(.*?)\|>\n", 1)).alias("role"), unescape(F.regexp_replace(p, r"(?s)\A<\|.*?\|>\n", "")).alias("text")
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order. A span lies at the end of its turn."""
    pieces = F.split(formatted, r"\n<\|end\|>\n")
    return F.transform(
        F.transform(F.array(pieces), lambda p: F.transform(spans, lambda s: F.right(F.get(p, s["turn"]), (s["end"] - s["start"]).cast("int"))))[0],
        lambda x: unescape(x),
    )
