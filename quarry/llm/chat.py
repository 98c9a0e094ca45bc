r"""Chat formatting over reply trees.

A table of messages (tree, id, parent, role, text, score) holds replies to
replies. Iterative self-joins enumerate the root-to-leaf paths, branches are
ranked by score, and every chosen path becomes one conversation.

Method: a self-join finds each message's parent; further self-joins double the
step (parent, grandparent, ...), so log2(depth) rounds give every message its
depth and the sum of scores from its root. A leaf's branch is ranked by that
sum within its tree. The chosen leaves then walk up again by the same tables,
one per power of two, which yields each (path, message, depth) exactly once.
These rounds move ids only; tables written in the shared folder cut the
lineage. Texts join at the end. Built-in functions only.

Template: ``<s>``, then per turn ``[INST]text[/INST]`` (user), ``text</s>``
(assistant), ``[SYS]text[/SYS]`` (system) or ``[ROLE]role[AS]text[END]``. In a
text or role, a control string gets one backslash behind its first character
(one more if it has some), so none occurs there, and reading takes one away.
``segments`` are the pieces of the conversation in order, with ``loss`` true on
the assistants' texts alone.

Defined cases: null roles and texts are empty; null scores count 0; a parent
that isn't in the tree makes a root; messages on or below a circle, and those
with a null id, are on no path; a null tree is a tree; a message that is
repeated stands in its path once per row, its parent the smallest and its
score the largest of its rows; equal scores rank by leaf id; messages of one
depth in one path sort by role and text; an empty table gives an empty result;
further columns are left out. Nothing is cut. A path is one row of the result,
so it has to fit into one; a tree has not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

#: The template's control strings, as patterns.
ANGLE = r"/?s>"
SQUARE = r"(?:/?(?:INST|SYS)|ROLE|AS|END)\]"
CONTROL = rf"<{ANGLE}|\[{SQUARE}"
OPEN = {"user": "[INST]", "system": "[SYS]"}
CLOSE = {"user": "[/INST]", "system": "[/SYS]", "assistant": "</s>"}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<=<)(?=\\*+{ANGLE})|(?<=\[)(?=\\*+{SQUARE})", r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<=<)\\(?=\\*+{ANGLE})|(?<=\[)\\(?=\\*+{SQUARE})", "")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """From (tree, id, parent, score): the messages with their depth and the
    sum of scores from the root; per power of two, (tree, id, up) with the
    ancestor that many steps up; and the messages that are parents."""
    parents = nodes.select(F.col("tree").alias("t"), F.col("id").alias("up"))
    steps = nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("up")), "left")
    first = written(steps.select(
        "tree", "id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("score").alias("total"),
    ), "chat-step-0")
    done, live = [first.where("up IS NULL")], first.where("up IS NOT NULL")
    levels: list[DataFrame] = []
    # No path is longer than the table; what still climbs then runs in a circle.
    for _ in range(first.count().bit_length()):
        if live.isEmpty():
            break
        levels.append(live.select("tree", "id", "up"))
        above = _union([*done, live]).select(
            F.col("tree").alias("t"), F.col("id").alias("at"), F.col("up").alias("next"),
            F.col("depth").alias("more"), F.col("total").alias("sum"),
        )
        step = written(
            live.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("at"))).select(
                "tree", "id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("total") + F.col("sum")).alias("total"),
            ), f"chat-step-{len(levels)}",
        )
        done.append(step.where("up IS NULL"))
        live = step.where("up IS NOT NULL")
    return _union(done), levels, first.where("up IS NOT NULL").select("tree", F.col("up").alias("id")).distinct()


def reply_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, id, depth): the messages on the ``best``
    branches of each tree (all, unranked, if None), by (tree, id, parent,
    score). A branch's score is the sum of its messages' scores."""
    nodes = written(
        messages.where("id IS NOT NULL").groupBy("tree", "id")
        .agg(F.min("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0)).cast("double").alias("score")),
        "chat-nodes",
    )
    reached, levels, parents = _climb(nodes)
    parents = parents.select(F.col("tree").alias("t"), F.col("id").alias("p"))
    leaves = reached.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p")), "left_anti")
    rank: Column = F.lit(None).cast("int")
    if best is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("total").desc(), "id"))
    leaves = leaves.withColumn("rank", rank)
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    parts = [written(leaves.select("tree", F.col("id").alias("leaf"), "rank", F.col("total").alias("score"), "id", "depth"), "chat-path-leaf")]
    for k, level in enumerate(levels):
        up = level.select(F.col("tree").alias("t"), F.col("id").alias("at"), "up")
        parts.append(written(
            _union(parts).join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("at"))).select(
                "tree", "leaf", "rank", "score", F.col("up").alias("id"), (F.col("depth") - (1 << k)).alias("depth"),
            ), f"chat-path-{k}",
        ))
    return _union(parts)


def _segments(turns: Column) -> Column:
    """Pieces of the conversation: struct(text, loss)."""
    piece = lambda text, loss=False: F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    def turn(t: Column) -> Column:
        role, text = t["role"], escape(t["text"])
        out = F.array(piece(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[AS]"), text, F.lit("[END]"))))
        for name, mark in OPEN.items():
            out = F.when(role == name, F.array(piece(F.concat(F.lit(mark), text, F.lit(CLOSE[name]))))).otherwise(out)
        return F.when(role == "assistant", F.array(piece(text, True), piece(F.lit(CLOSE["assistant"])))).otherwise(out)

    return F.concat(F.array(piece(F.lit("<s>"))), F.flatten(F.transform(turns, turn)))


def format_trees(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, conversation, segments): one row per chosen
    path of ``messages`` (tree, id, parent, role, text, score)."""
    paths = reply_paths(messages, best)
    texts = messages.select(
        F.col("tree").alias("t"), F.col("id").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = (
        paths.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("at")))
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    )
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return (
        turns.withColumn("segments", _segments(F.col("turns")))
        .select("tree", "leaf", "rank", "score", joined.alias("conversation"), "segments")
    )


def read_turns(conversation: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation: the texts that
    end in a closing control string."""
    marks = F.regexp_extract_all(conversation, F.lit(CONTROL), F.lit(0))
    parts = F.split(conversation, CONTROL, -1)
    before = F.concat(F.array(F.lit("")), parts)
    rows = F.arrays_zip(marks.alias("mark"), parts.alias("text"), before.alias("name"))
    ends = F.filter(rows, lambda r: r["mark"].isin(*CLOSE.values(), "[END]"))

    def turn(r: Column) -> Column:
        role = unescape(r["name"])
        for name, mark in CLOSE.items():
            role = F.when(r["mark"] == mark, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(r["text"]).alias("text"))

    return F.transform(ends, turn)


def as_chains(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as reply trees: each row answers the
    one before it by turn (null first), ties by role and md5 of the text."""
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("h", F.md5("text"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "h")
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("id") > 1, F.col("id") - 1)
    return rows.select("tree", "id", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def digest(conversations: DataFrame, best: int = 4) -> DataFrame:
    """The query's columns, read back from the formatted conversations; the
    table plus conversation -7, whose texts spell control strings."""
    spark = conversations.sparkSession
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(planted)
    made = format_trees(as_chains(rows), best).withColumn("turns", read_turns(F.col("conversation")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.withColumn("loss", loss).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("conversation").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
    len(regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*(?:/?(?:INST|SYS)|ROLE|AS|END)\])', '[\\\1', 'g')) AS n,
    len(regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*(?:/?(?:INST|SYS)|ROLE|AS|END)\])', '[\\\1', 'g')) AS role_n
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 4 ELSE 15 + role_n END))::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""
