"""Reply trees as training conversations.

Messages point at the message they answer. Ancestor pointers double in every self-join
until they pass the root, adding up the scores on the way, so a tree of depth d takes log d
joins. The leaves of each tree are ranked by the score of their branch; the pointers then
enumerate the paths of the best leaves, again in log d joins. Each chosen path is formatted
as one conversation: a marked turn per message, with the spans of assistant texts as loss
mask. Control strings inside texts are escaped and can be restored exactly.

DataFrame functions throughout. Every join is on a message's own id, so one huge tree is
no hot key; only the finished conversation, one string by definition, is built in one task.

Defined results: NULL roles and texts count as empty; a parent that does not exist makes a
root; messages that reach no root (cycles) belong to no conversation and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, running_total, stored

START, END, LOSS_ROLE = "<|im_start|>", "<|im_end|>", "assistant"


def escaped(text: Column, line: bool = False) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so no control string is left; in one-line fields a newline becomes ``\/``."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\/")) if line else out


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``: escaped backslashes part the text, all else is replaced between them."""
    parts = F.transform(F.split(text, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\/"), F.lit("\n")))
    return F.array_join(parts, "\\")


def branches(messages: DataFrame, id_col: str = "id", parent_col: str = "parent", score_col: str = "score",
             best: int = 1) -> DataFrame:
    """(root, leaf, branch, score, id, depth): the paths of the ``best`` branches of every tree, root at depth 0.

    A branch's score is the sum over its messages; ties go to the deeper, then the smaller leaf.
    """
    given = stored(messages.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"),
                                   F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)).alias("score")), "chat-messages")
    known = given.join(given.select(F.col("id").alias("parent"), F.lit(True).alias("known")), "parent", "left")
    state = stored(known.select("id", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("total"),
                                F.lit(1).cast("long").alias("steps"), F.col("id").alias("top")), "chat-pointers")
    jumps, most = [], given.count()
    # pointers of 2^k steps; after log2 of all messages whatever still points somewhere is on a cycle
    while len(jumps) <= max(1, most).bit_length() and not state.filter("up is not null").isEmpty():
        jumps.append(state)
        above = state.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"),
                             F.col("steps").alias("steps2"), F.col("top").alias("top2"))
        state = stored(state.join(above, "up", "left").select(
            "id", F.col("up2").alias("up"), (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), F.coalesce("top2", "top").alias("top")), "chat-pointers")
    leaves = (state.filter("up is null").join(given.select(F.col("parent").alias("id")).distinct(), "id", "left_anti")
              .select(F.col("top").alias("root"), F.col("id").alias("leaf"), "total", "steps"))
    order = Window.partitionBy("root").orderBy(F.desc("total"), F.desc("steps"), "leaf")
    paths = (leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= best)
             .select("root", "leaf", "branch", F.col("total").alias("score"), F.col("leaf").alias("id")))
    for jump in reversed(jumps):
        up = paths.join(jump.filter("up is not null").select("id", "up"), "id").select(
            "root", "leaf", "branch", "score", F.col("up").alias("id"))
        paths = stored(paths.unionByName(up), "chat-paths")
    out = stored(paths.join(state.select("id", (F.col("steps") - 1).alias("depth")), "id"), "chat-branches")
    for df in [given, state, *jumps]:
        discard(df)
    return out


def formatted(paths: DataFrame, messages: DataFrame, id_col: str = "id", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(root, branch, score, n_turns, formatted, loss_spans): one conversation per path.

    ``loss_spans`` are code point ranges (end exclusive) of the assistant texts as they stand in ``formatted``.
    """
    role = escaped(F.coalesce(F.col(role_col), F.lit("")), line=True)
    turns = messages.select(F.col(id_col).alias("id"), role.alias("role"), escaped(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
                            (F.col(role_col) == LOSS_ROLE).alias("loss"))
    line = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(f"{END}\n"))
    placed = paths.join(turns, "id").select("root", "leaf", "branch", "score", F.struct(
        "depth", line.alias("turn"), (F.length("role") + len(START) + 1).alias("lead"), F.length("text").alias("size"),
        F.coalesce("loss", F.lit(False)).alias("loss")).alias("t"))
    whole = (placed.groupBy("root", "leaf", "branch", "score").agg(F.array_sort(F.collect_list("t")).alias("turns"))
             .withColumn("ends", running_total(F.transform("turns", lambda t: F.length(t["turn"])))))
    spans = F.transform(F.filter(F.arrays_zip(F.col("turns").alias("turns"), F.col("ends").alias("ends")), lambda z: z["turns"]["loss"]), lambda z: F.struct(
        (z["ends"] - F.length(z["turns"]["turn"]) + z["turns"]["lead"]).alias("start"),
        (z["ends"] - F.length(z["turns"]["turn"]) + z["turns"]["lead"] + z["turns"]["size"]).alias("end")))
    return whole.select("root", "branch", "score", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def turns_of(text: Column) -> Column:
    """Read a formatted conversation back: array of (role, text), unescaped."""
    parts = F.split(text, r"<\|im_start\|>", -1)
    bodies = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.split(F.split(p, r"<\|im_end\|>", -1)[0], "\n", 2))
    return F.transform(bodies, lambda b: F.struct(unescaped(b[0]).alias("role"), unescaped(b[1]).alias("text")))


def loss_text(text: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def conversation_digest(found: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    read = found.withColumn("turns", turns_of(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("root", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def linear_thread(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(id, parent, conv_id, role, text, score): rows of plain conversations, each answering the row before it.

    Rows stand by turn (NULL first), equal turns by role and text; the rows of conv_id NULL are one conversation.
    """
    order = Window.partitionBy(conv_col).orderBy(F.col(turn_col).asc_nulls_first(), F.col(role_col).asc_nulls_first(),
                                                 F.col(text_col).asc_nulls_first())
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    at = rows.select(F.col(conv_col).alias("conv_id"), F.row_number().over(order).alias("at"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return at.select(F.concat_ws("/", name, "at").alias("id"), F.when(F.col("at") > 1, F.concat_ws("/", name, F.col("at") - 1)).alias("parent"),
                     "conv_id", "role", "text", F.lit(0.0).alias("score"))
