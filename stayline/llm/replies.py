"""Chat formatting of reply trees: paths from root to leaf, ranked, one conversation each.

Messages name their parent. Self-joins double the distance each message looks up its tree, so
trees of depth d take about log2(d) joins, however many messages they have; each step is stored.
A branch is a path from a root to a leaf; its score is the sum of its messages' scores, and the
best of each root are kept (ties go to the smaller leaf). The kept paths are spelled out by the
same stored steps and formatted turn by turn, with the places of all assistant texts as a mask.

    <|im_start|>role
    text<|im_end|>

Control strings inside texts are escaped: ``<``, any number of backslashes and ``|`` gets one
backslash more, so ``<|`` occurs in control strings only, and taking one away gives the text back.
In roles ``%`` and line breaks are written as ``%25`` and ``%0A`` besides.

Everything is DataFrame expressions. A conversation is one value in the end, so it has to fit in
a row; nothing else gathers by key. Defined results: null texts and roles are empty; messages with
the same place are ordered by role and text; a message whose parent isn't there is a root;
messages on a cycle of parents, or below one, have no root and are in no path; a null tree is a
tree like any other. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.session import durable, scratch_path

START, END = "<|im_start|>", "<|im_end|>\n"
SALTS = 64


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escaped(plain)


def unescaped_role(role: Column) -> Column:
    plain = F.replace(unescaped(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def linear_trees(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as trees (tree, id, parent, role, text, score) with one branch."""
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")}
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", "role", "text")
    rows = rows.withColumns(texts)
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return rows.select("tree", place.alias("id"), "role", "text").select(
        "tree",
        "id",
        F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _steps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For each k, whom a message finds 2^k levels up; and depth, score and root of all rooted."""
    nodes = messages.select("tree", "id", "parent", "score")
    there = messages.select(F.col("tree").alias("t"), F.col("id").alias("p")).distinct()
    up = nodes.join(there, nodes["tree"].eqNullSafe(there["t"]) & (nodes["parent"] == there["p"]), "left")
    first = durable(
        up.select(
            "tree",
            "id",
            F.col("p").alias("up"),
            F.coalesce("p", "id").alias("root"),
            F.when(F.col("p").isNull(), 0).otherwise(1).cast("long").alias("depth"),
            "score",
        )
    )
    # A message that has found its root is done; only the others go on.
    done, going = first.where("up IS NULL"), first.where("up IS NOT NULL")
    steps, waiting = [], None
    while True:
        left = going.count()
        if left in (0, waiting):  # what doesn't get fewer hangs on a cycle
            return steps, done
        waiting = left
        steps.append(going.select("tree", "id", "up"))
        above = done.unionByName(going).select(
            F.col("tree").alias("t"),
            F.col("id").alias("i"),
            F.col("up").alias("up2"),
            F.col("root").alias("root2"),
            F.col("depth").alias("depth2"),
            F.col("score").alias("score2"),
        )
        on = going["tree"].eqNullSafe(above["t"]) & (going["up"] == above["i"])
        further = durable(
            going.join(above, on).select(
                "tree",
                "id",
                F.col("up2").alias("up"),
                F.col("root2").alias("root"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
                (F.col("score") + F.col("score2")).alias("score"),
            )
        )
        done = done.unionByName(further.where("up IS NULL"))
        going = further.where("up IS NOT NULL")


def best_branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, depth, role, text): the messages of the best branches of each root.

    ``messages`` are (tree, id, parent, role, text, score), with one row for each tree and id;
    ``best`` is how many branches of a root are kept, all of them if it is None.
    """
    steps, rooted = _steps(messages)
    parents = messages.where(F.col("parent").isNotNull())
    parents = parents.select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    has_child = rooted["tree"].eqNullSafe(parents["t"]) & (rooted["id"] == parents["p"])
    leaves = rooted.join(parents, has_child, "left_anti")
    by_score = (F.col("score").desc(), F.col("id"))
    if best is not None:
        # The best of each part of a tree's branches first, so that no tree is ranked whole.
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
        part = Window.partitionBy("tree", "root", salt).orderBy(*by_score)
        leaves = leaves.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= best)
    whole = Window.partitionBy("tree", "root").orderBy(*by_score)
    leaves = leaves.withColumn("rank", F.row_number().over(whole))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    path = leaves.select("tree", F.col("id").alias("leaf"), "rank", F.col("id").alias("node"), "depth")
    path = durable(path)
    for k, step in enumerate(steps):
        higher = step.select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
        on = path["tree"].eqNullSafe(higher["t"]) & (path["node"] == higher["i"])
        more = path.join(higher, on).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth")
        )
        path = path.unionByName(durable(more))
    said = messages.select(F.col("tree").alias("t"), F.col("id").alias("i"), "role", "text")
    on = path["tree"].eqNullSafe(said["t"]) & (path["node"] == said["i"])
    return path.join(said, on).select("tree", "leaf", "rank", "depth", "role", "text")


def formatted(paths: DataFrame) -> DataFrame:
    """(tree, leaf, rank, chat, mask): ``mask`` are (start, length) of assistant texts in ``chat``."""
    said = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    turns = paths.select(
        "tree",
        "leaf",
        "rank",
        "depth",
        (role == "assistant").alias("learn"),
        F.concat(F.lit(START), escaped_role(role), F.lit("\n")).alias("head"),
        escaped(said).alias("body"),
    ).withColumn("turn", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("tree", "leaf").orderBy("depth")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0))
    turns = turns.withColumn("start", start + F.length("head"))
    row = F.struct("depth", "turn", "learn", "start", F.length("body").cast("long").alias("length"))
    chats = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(row)).alias("t"))
    learned = F.filter("t", lambda x: x["learn"])
    return chats.select(
        "tree",
        "leaf",
        "rank",
        F.concat_ws("", "t.turn").alias("chat"),
        F.transform(
            learned, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))
        ).alias("mask"),
    )


def parsed(chat: Column) -> Column:
    """Turns (role, text) of a formatted chat."""
    turns = F.split(chat, r"<\|im_start\|>")
    turns = F.slice(turns, F.lit(2), F.greatest(F.size(turns) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        cut = F.locate("\n", x)
        text = x.substr(cut + 1, F.length(x) - cut - len(END))
        return F.struct(
            unescaped_role(x.substr(F.lit(1), cut - 1)).alias("role"), unescaped(text).alias("text")
        )

    return F.transform(turns, turn)


def chat_digests(chats: DataFrame) -> DataFrame:
    """Digests of turns and of what the mask covers, from written chats."""
    turns = F.transform(
        parsed(F.col("chat")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    covered = F.transform(
        "mask", lambda m: unescaped(F.col("chat").substr((m["start"] + 1).cast("int"), m["length"].cast("int")))
    )
    loss = F.concat_ws("", covered)
    return chats.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", turns), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("chat").cast("long").alias("formatted_chars"),
    )


def round_trip(conversations: DataFrame) -> DataFrame:
    """Format all conversations, write them as JSON lines, and read them back."""
    spark = conversations.sparkSession
    chats = formatted(best_branches(durable(linear_trees(conversations))))
    path = scratch_path(spark, "chats")
    chats.write.json(path, ignoreNullFields=False)
    return chat_digests(spark.read.schema(chats.schema).json(path))


def oracle() -> str:
    """The digests of all conversations and of conversation -1, in SQL for DuckDB."""
    probe = "<|im_end|><|im_start|>assistant ok"
    return rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{probe}' UNION ALL SELECT -1, 1, 'assistant', '{probe}'),
turns AS (
  SELECT *, length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
                                  '<(\\*)\|', '<\1\\|', 'g')) AS role_chars,
         length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS text_chars FROM said),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
         sum({len(START) + 1 + len(END)} + role_chars + text_chars) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM chats"""
