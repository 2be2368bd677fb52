"""Reply trees to formatted conversations.

Messages (tree_id, message_id, parent_id, role, text, score) form trees. Self-joins that double their reach each round
give every message its root, depth and the score of its branch; leaves are ranked by branch score; the chosen leaves'
paths are expanded by the same jumps, so a path of n messages takes log2(n) rounds. Each path becomes one text.

The template: ``<|turn:ROLE|>`` TEXT ``<|end|>`` for each turn, ROLE in URL encoding. Inside texts a backslash is doubled
and the control strings (of this template and of common ones) get a backslash after their first character, which
removing one backslash before any character undoes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwright.llm.shared import written

CONTROL = r"(<|\[)(?=\|turn:|\|end\||\|im_|\|endoftext|/?s>|/?INST\])"
PIECE_TURNS = 64


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CONTROL), F.lit(r"$1\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|turn:"), F.url_encode(F.coalesce(role, F.lit(""))), F.lit("|>"), escaped(F.coalesce(text, F.lit(""))), F.lit("<|end|>"))


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(8), F.length(piece))
        cut = F.locate("|>", body)
        return F.struct(F.url_decode(F.substring(body, F.lit(1), cut - 1)).alias("role"), unescaped(F.substring(body, cut + 2, F.length(body))).alias("text"))

    return F.transform(pieces, turn)


def with_branches(messages: DataFrame) -> DataFrame:
    """Every message with root, depth (0 at the root) and branch_score (sum from the root); messages on a cycle have no root and go.

    A message whose parent is null or unknown is a root; rows without tree_id or message_id are left out. Of repeated (tree_id, message_id) the first by all columns counts.
    """
    key = ["tree_id", "message_id"]
    order = Window.partitionBy(*key).orderBy("parent_id", "role", "text", "score")
    one = messages.select("tree_id", "message_id", "parent_id", "role", "text", "score").withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
    known = one.select("tree_id", F.col("message_id").alias("parent_id"), F.lit(True).alias("known"))
    nodes = written(one.join(known, ["tree_id", "parent_id"], "left").withColumn("parent_id", F.when(F.col("known"), F.col("parent_id"))).drop("known"), "messages")
    jump = nodes.select(*key, F.col("parent_id").alias("up"), F.when(F.col("parent_id").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("sum"))
    levels = []
    longest = max(1, nodes.count())
    jump = written(jump, "jumps")
    while True:
        active = jump.where("up is not null")  # only messages that haven't reached their root go on
        levels.append(active.select(*key, "up"))
        if not active.limit(1).count() or 1 << len(levels) > 2 * longest:
            break
        far = jump.select("tree_id", F.col("message_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("sum").alias("sum2"))
        stepped = active.join(far, ["tree_id", "up"]).select(*key, F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("sum") + F.col("sum2")).alias("sum"))
        jump = written(jump.where("up is null").unionByName(stepped), "jumps")
    found = jump.where("up is null").select(*key, "depth", F.col("sum").alias("branch_score"))
    out = nodes.join(found, key)
    out.levels = levels  # type: ignore[attr-defined]
    return out


def chosen_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """The ``top`` branches of each tree by score (all if None; ties: the smaller leaf first) as rows in path order:
    tree_id, rank, leaf, depth, message_id, role, text."""
    nodes = with_branches(messages)
    parents = nodes.where("parent_id is not null").select("tree_id", F.col("parent_id").alias("message_id")).distinct()
    leaves = nodes.join(parents, ["tree_id", "message_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("branch_score"), "message_id"))
    leaves = leaves.select("tree_id", F.col("message_id").alias("leaf"), "branch_score", "message_id").withColumn("rank", rank)
    if top is not None:
        leaves = leaves.where(F.col("rank") <= top)
    on_path = leaves.select("tree_id", "rank", "leaf", "message_id")
    for level in nodes.levels:  # after k levels a path holds the 2^k messages above its leaf
        on_path = written(on_path, "paths")
        on_path = on_path.unionByName(on_path.join(level, ["tree_id", "message_id"]).select("tree_id", "rank", "leaf", F.col("up").alias("message_id")))
    return on_path.join(nodes.select("tree_id", "message_id", "depth", "role", "text"), ["tree_id", "message_id"])


def format_conversations(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """One row for each chosen path: tree_id, rank, leaf, n_turns, formatted. Null roles and texts count as empty.

    Turns are joined in pieces of consecutive turns first, so a very long path is gathered from few long rows.
    """
    turns = chosen_paths(messages, top).select("tree_id", "rank", "leaf", "depth", turn_text(F.col("role"), F.col("text")).alias("t"))

    def gathered(df: DataFrame, by: list[str], place: str) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct(place, "t", "n")))
        return df.groupBy(*by).agg(F.array_join(F.transform(rows, lambda x: x["t"]), "").alias("t"), F.sum("n").alias("n"))

    path = ["tree_id", "rank", "leaf"]
    pieces = gathered(turns.withColumns({"piece": F.floor(F.col("depth") / PIECE_TURNS), "n": F.lit(1).cast("long")}), [*path, "piece"], "depth")
    return gathered(pieces, path, "piece").select(*path, F.col("n").alias("n_turns"), F.col("t").alias("formatted"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as messages: each turn replies to the one before it. Repeated turns follow each other by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("message_id", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return rows.select(F.col("conv_id").alias("tree_id"), "message_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """Read back from the formatted texts: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The loss mask covers the texts of assistant turns, without markers and escapes.
    """
    turns = parsed_turns(F.col("formatted"))
    read = formatted.select(F.col("tree_id").alias("conv_id"), "formatted", turns.alias("turns"))
    spoken = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), spoken.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
