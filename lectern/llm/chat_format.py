"""Reply trees formatted as conversations.

Messages are nodes with a parent; a root-to-leaf path is a conversation.
Paths are enumerated by iterative self-joins: doubling gives every node its
ancestor 1, 2, 4, ... steps up, with path length and score summed on the way;
the leaves of a tree rank its branches; and the chosen leaves' paths are read
off the doubled links from the largest step down, so only chosen paths are
ever written out, never a path for each node.

A turn is ``### <role>: <text> </turn>\\n``.  In texts and roles a backslash,
``<``, ``#`` (and in roles ``:``) are written as a backslash and a letter, so a
text can't hold a control string, and :func:`read_back` gives the exact texts.
The loss mask holds for each turn which of its characters are learned.

Defined cases: a null text or role is empty; a parent that doesn't exist makes
its child a root; messages that lead into a circle have no root and are left
out; ties in score go to the longer, then to the smaller leaf; an empty table
gives an empty result.  Trees and nodes need an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
SIGNS = {"\\": "\\b", "<": "\\l", "#": "\\h", ":": "\\c"}  # the backslash first; read back in the opposite order
LEARNED = "assistant"
KEY = ["tree", "node"]


def escaped(text: Column, signs: str = "\\<#") -> Column:
    for sign, code in SIGNS.items():
        if sign in signs:
            text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for sign, code in reversed(SIGNS.items()):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def doubled_links(nodes: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up) of the ancestor 2^k steps up, and (tree, node, steps, total) of paths to a root."""
    known = nodes.select("tree", F.col("node").alias("up"), F.lit(True).alias("there"))
    now = (nodes.select("tree", "node", F.col("parent").alias("up"), "score").join(known, ["tree", "up"], "left")
           .select("tree", "node", F.when(F.col("there"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")))
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    links = []
    for k in range(largest.bit_length() + 1):
        now = scratch.keep(now, f"up{k}")
        below = now.where("up is not null")
        if below.isEmpty():
            break
        links.append(below.select("tree", "node", "up"))
        ahead = now.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("s2"), F.col("total").alias("t2"))
        moved = below.join(ahead, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("s2")).alias("steps"), (F.col("total") + F.col("t2")).alias("total"))
        now = moved.unionByName(now.where("up is null"))  # what has come to its root stays as it is
    return links, now.where("up is null").select(*KEY, "steps", "total")  # what still leads up is in a circle


def branches(nodes: DataFrame, best: int | None, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The doubled links, and (tree, leaf, branch, turns, total): the ``best`` branches of each tree (None: all)."""
    links, paths = doubled_links(nodes, scratch)
    parents = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = paths.join(parents, KEY, "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "node")
    ranked = leaves.select("tree", F.col("node").alias("leaf"), F.row_number().over(order).alias("branch"), F.col("steps").alias("turns"), "total")
    return links, ranked if best is None else ranked.where(F.col("branch") <= best)


def path_nodes(links: list[DataFrame], chosen: DataFrame, scratch: Scratch) -> DataFrame:
    """(tree, leaf, node, turn): every message of the chosen branches, turns from 0 at the root.

    Each step is written, as it reads the last one twice.
    """
    out = chosen.select("tree", "leaf", F.col("leaf").alias("node"), (F.col("turns") - 1).alias("turn"))
    for k in reversed(range(len(links))):
        above = out.join(links[k], KEY).select("tree", "leaf", F.col("up").alias("node"), (F.col("turn") - (1 << k)).alias("turn"))
        out = scratch.keep(out.unionByName(above), f"path{k}")
    return out


def format_trees(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None = None, *,
                 best: int | None = 1, learned: str = LEARNED) -> DataFrame:
    """Per chosen branch: tree, leaf, branch, formatted, and loss: for each turn (start, length) of its learned characters."""
    scratch = Scratch(messages.sparkSession, "chat")
    points = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = scratch.keep(messages.select(F.col(tree).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("parent"), points.alias("score"),
                                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), "messages")
    links, chosen = branches(rows.select(*KEY, "parent", "score"), best, scratch)
    chosen = scratch.keep(chosen, "branches")
    places = path_nodes(links, chosen, scratch)
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), "\\<#:"), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    turn = F.struct(F.col("turn"), F.concat(head, body, F.lit(TAIL)).alias("piece"), F.length(head).alias("start"),
                    F.when(F.col("role") == learned, F.length(body)).otherwise(0).alias("length"))
    turns = places.join(rows, KEY).groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return turns.join(chosen.select("tree", "leaf", "branch"), ["tree", "leaf"]).select(
        "tree", "leaf", "branch", F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` plus turns (array of role, text) and learned (array of texts under the mask, with nothing for the other turns)."""
    pieces = F.split("formatted", TAIL, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    out = formatted.withColumn("__pieces", pieces)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, MIDDLE)
        return F.struct(unescaped(F.substring(piece, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                        unescaped(F.substring(piece, at + len(MIDDLE), F.length(piece))).alias("text"))

    masked = F.zip_with("__pieces", "loss", lambda p, s: unescaped(F.substring(p, s["start"] + 1, s["length"])))
    return out.select("*", F.transform("__pieces", turn).alias("turns"), masked.alias("learned")).drop("__pieces")


def threads(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees of one branch: each row answers the one before it.

    Rows are taken by turn (nulls first), then role and text; a null conv_id
    is a conversation of its own, under the smallest number of the type.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 63))).alias("tree"), "turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
