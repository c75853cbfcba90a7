"""Reply trees as training conversations, with DataFrame functions only.

Messages point to the message that they answer. Self-joins that double their reach
tell each message's root, depth and branch score in log2(depth) rounds; the leaves
are ranked by the scores of their branches, and the chosen paths are read off the
same jumps. A path is written with a template that marks turns; control strings
inside texts are escaped so that the text can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unstage

#: The template: what opens a turn, what follows its role, what closes it.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Control strings inside texts and what stands for them. The first must be the escape
#: sign itself, so that undoing them in reverse order gives the text again.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\e"), ("### ", "\\h"), (": ", "\\c"))


def escape(text: Column) -> Column:
    for raw, stands in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(stands))
    return text


def unescape(text: Column) -> Column:
    for raw, stands in reversed(ESCAPES):
        text = F.replace(text, F.lit(stands), F.lit(raw))
    return text


def known(conv: Column) -> Column:
    """A conversation's key that also joins where the id is null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null"))


def branch_jumps(messages: DataFrame) -> list[DataFrame]:
    """Tables k = 0, 1, ..: each message (conv, id) with its ancestor 2**k above (up,
    null beyond the root), and over the messages passed their number and their score.
    Messages that answer none of their conversation are roots. Staged, one a round."""
    ids = messages.select("conv", F.col("id").alias("parent"), F.lit(True).alias("there"))
    first = (
        messages.select("conv", "id", "parent", "score")
        .join(ids, ["conv", "parent"], "left")
        .select("conv", "id", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), "score")
    )
    tables = [staged(first, "jump")]
    total, live = tables[0].agg(F.count(F.lit(1)), F.count("up")).first()
    # Past as many messages as there are, only circles go on; they reach no root.
    while live and 1 << (len(tables) - 1) <= total:
        last = tables[-1]
        above = last.select("conv", F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("score").alias("gain"))
        longer = (
            last.where("up is not null")  # what has reached its root is carried on without a join
            .join(above, ["conv", "up"])
            .select("conv", "id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("gain")).alias("score"))
        )
        tables.append(staged(longer.unionByName(last.where("up is null")), "jump"))
        live = tables[-1].where("up is not null").count()
    return tables


def best_paths(messages: DataFrame, n_best: int = 1) -> DataFrame:
    """(conv, path, rank, branch_score, position, id) of the chosen root-to-leaf paths,
    path being the leaf. A conversation's branches are ranked by mean score, then by
    the leaf's id. Messages in circles are on no path."""
    jumps = branch_jumps(messages)
    leaves = jumps[-1].where("up is null").join(messages.select("conv", F.col("parent").alias("id")), ["conv", "id"], "left_anti")
    order = Window.partitionBy("conv").orderBy(F.desc("mean"), "id")
    chosen = leaves.withColumn("mean", F.col("score") / F.col("depth")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_best)
    steps = chosen.select(
        "conv", F.col("id").alias("path"), "rank", F.col("mean").alias("branch_score"), "depth",
        F.col("id").alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth") - 1)).alias("above"),
    )
    # The message `above` steps up is reached by the jumps of that number's binary digits;
    # only rows that take a jump are joined.
    held = None
    for k in reversed(range(len(jumps))):
        last, held = held, staged(steps, "steps")
        if last is not None:
            unstage(last)
        takes = F.shiftright("above", k).bitwiseAND(F.lit(1).cast("long")) == 1
        hop = jumps[k].where("up is not null").select("conv", F.col("id").alias("at"), F.col("up").alias("to"))
        moved = held.where(takes).join(hop, ["conv", "at"]).withColumn("at", F.col("to")).select(*held.columns)
        steps = held.where(~takes).unionByName(moved)
    return steps.select("conv", "path", "rank", "branch_score", (F.col("depth") - 1 - F.col("above")).alias("position"), F.col("at").alias("id"))


def format_conversations(messages: DataFrame, n_best: int = 1) -> DataFrame:
    """One row per chosen path: conv_id, path, rank, branch_score, formatted (string),
    loss (array of start, length in code points: the assistant texts as written).

    messages: conv_id, id, parent, role, text, score. Null roles and texts are empty,
    null scores 0; rows of one conversation should have ids of their own (of rows with
    an equal id, one that sorts first is used); messages without a conversation id are
    one conversation; an empty table gives none; other columns are not read.
    """
    base = messages.select(
        "conv_id", known(F.col("conv_id")).alias("conv"), "id", "parent",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    one = base.groupBy("conv", "id").agg(F.min(F.struct("parent", "role", "text", "score", "conv_id")).alias("m")).select("conv", "id", "m.*")
    one = staged(one, "messages")
    paths = best_paths(one.select("conv", "id", "parent", "score"), n_best)
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(COLON))
    turns = paths.join(one.select("conv", "id", "conv_id", "role", "text"), ["conv", "id"]).select(
        "conv", "path", "rank", "branch_score", "position", "conv_id", (F.col("role") == "assistant").alias("learnt"), head.alias("head"), escape(F.col("text")).alias("body")
    )
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    before = Window.partitionBy("conv", "path").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head"))
    turn = F.struct("position", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "learnt", "start", F.char_length("body").cast("long").alias("length"))
    return (
        placed.groupBy("conv", "path").agg(F.first("conv_id").alias("conv_id"), F.first("rank").alias("rank"), F.first("branch_score").alias("branch_score"), F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id", "path", "rank", "branch_score",
            F.array_join(F.col("turns.piece"), "").alias("formatted"),
            F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
        )
    )


def read_turns(formatted: str = "formatted") -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(F.col(formatted), "</turn>\\n")

    def turn(piece: Column) -> Column:
        colon = F.instr(piece, COLON)
        return F.struct(
            unescape(F.substring(piece, len(OPEN) + 1, colon - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, colon + len(COLON), F.char_length(piece))).alias("text"),
        )

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def masked_text(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(F.col(formatted), (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")


def threads(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as messages: each turn answers
    the one before. Equal turns follow by role and text. The score is the text's length."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", "turn", "role", "text", at.alias("id")).select(
        "conv_id", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.coalesce(F.char_length("text"), F.lit(0)).cast("double").alias("score")
    )
