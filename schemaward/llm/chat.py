"""Reply trees to conversations: paths from root to leaf, branches ranked by score, one formatted text per path.

The nodes of all paths come from self-joins that double the distance they cover, so a tree of depth d takes about
log2(d) rounds; each round is written to the shared folder. Texts join only the chosen paths, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schemaward.llm.batches import store

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """One more backslash inside every "<|", "<\\|", .., so that no control string is left; ``unescape`` undoes it."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    halves = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(halves, "\\")


def path_nodes(nodes: DataFrame) -> DataFrame:
    """(leaf, node, up) for every node on the way from each leaf to its root, up being its distance from the leaf.

    ``nodes`` is (node, parent or null), both of one type; a parent that is no node counts as none, repeated nodes count once,
    and nodes of a cycle reach no leaf and no root, so they are on no path.
    """
    nodes = nodes.groupBy("node").agg(F.min("parent").alias("parent")).where("node is not null")
    known = nodes.select(F.col("node").alias("k"))
    jump = store(nodes.where("parent is not null").join(known, F.col("parent") == F.col("k"), "left_semi").select("node", F.col("parent").alias("to")), "jump")
    inner = jump.select(F.col("to").alias("k"))
    paths = store(nodes.join(inner, F.col("node") == F.col("k"), "left_anti").select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "paths")
    step = 1
    while True:
        further = paths.join(jump, "node").select("leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        grown = store(paths.unionAll(further), "paths")
        if further.limit(1).count() == 0:
            return paths
        paths, step = grown, step * 2
        jump = store(jump.alias("a").join(jump.select(F.col("node").alias("via"), F.col("to").alias("next")), F.col("to") == F.col("via")).select("node", F.col("next").alias("to")), "jump")


def format_trees(nodes: DataFrame, per_tree: int | None = None) -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss_spans): one row per chosen path, its turns from the root on.

    ``nodes`` is (node and parent of one type, tree long, role string, text string, score double). Branches of a tree rank
    by the sum of their scores, then by leaf; ``per_tree`` keeps that many, None keeps all. A turn reads
    ``<|im_start|>role\\ntext<|im_end|>\\n`` with control strings inside role and text escaped reversibly; loss_spans
    are (start, length) in characters of ``formatted`` and cover the text of each assistant turn. Null roles and texts
    are empty, null scores zero; a null tree is a tree of its own; other columns are ignored.
    """
    nodes = nodes.select("node", "parent", "tree", "role", "text", "score")
    paths = path_nodes(nodes)
    facts = nodes.groupBy("node").agg(F.min(F.struct("tree", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("f"))
    small = facts.select("node", "f.tree", "f.score")
    branches = paths.join(small, "node").groupBy("leaf").agg(F.sum("score").alias("score"), F.max_by("tree", "up").alias("tree"), F.count(F.lit(1)).alias("n_turns"))
    ranked = branches.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    chosen = ranked.where(F.col("rank") <= per_tree) if per_tree is not None else ranked
    turn = F.concat(F.lit(START), _escape_role(F.col("f.role")), F.lit("\n"))
    turns = paths.join(chosen, "leaf").join(facts, "node").select(
        "leaf", "tree", "rank", "n_turns", "up", turn.alias("head"), escape(F.col("f.text")).alias("body"), (F.col("f.role") == "assistant").alias("loss"))
    turns = turns.withColumn("part", F.concat("head", "body", F.lit(f"{END}\n")))
    # a path is one text, so its turns meet in one row
    whole = turns.groupBy("leaf", "tree", "rank", "n_turns").agg(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "part", F.length("head").alias("head"), F.length("body").alias("body"), "loss"))).alias("t"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    spans = F.aggregate("t", zero, lambda a, x: F.struct(
        (a["n"] + F.length(x["part"])).alias("n"),
        F.when(x["loss"], F.array_append(a["spans"], F.struct((a["n"] + x["head"]).alias("start"), x["body"].cast("long").alias("length")))).otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    return whole.select("tree", "leaf", "rank", "n_turns", F.array_join(F.transform("t", lambda x: x["part"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    def turn(x: Column) -> Column:
        cut = F.instr(x, "\n")
        return F.struct(_unescape_role(F.substring(x, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(x, cut + 1, F.length(x))).alias("text"))
    # every turn ends with the end mark and a line feed, and neither mark can stand inside one
    head, tail = len(START), len(END) + 1
    inner = F.substring(formatted, F.lit(head + 1), F.length(formatted) - head - tail)
    return F.transform(F.split(inner, r"<\|im_end\|>\n<\|im_start\|>"), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def linear_trees(turns: DataFrame) -> DataFrame:
    """Nodes of reply trees from (conv_id, turn, role, text): each row answers the one before it in its conversation.

    Rows of a conversation are ordered by turn, then role, then text, nulls first; a node is named by its conversation and place, null conversations
    by an empty name (an empty text is no conv_id).
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed = turns.select("conv_id", "turn", "role", "text").withColumn("_n", F.row_number().over(order))
    # conversation and place spelled out: no two nodes share a key
    number = lambda n: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), n.cast("string"))
    return placed.select(number(F.col("_n")).alias("node"), F.when(F.col("_n") > 1, number(F.col("_n") - 1)).alias("parent"), F.col("conv_id").alias("tree"), "role", "text", F.lit(0.0).alias("score"))
