"""Conversations from reply trees, in DataFrame functions.

Messages form trees: a message answers its ``parent``. Paths are found by
iterative self-joins that double their reach (binary lifting): table r has the
ancestor 2**r steps above each message that is at least that deep, so a tree
of depth d takes log2(d) joins and a long chain costs rows, not arrays of its
prefixes.

* A branch is a root-to-leaf path; its score is the sum of its messages'
  scores, which the same joins carry along. Branches of a tree are ranked by
  score, then by depth, then by leaf id; the best ``top`` are chosen.
* The messages of a chosen branch are found by walking its path again, two
  halves at a time: the chosen leaf's 2**r-jump splits a segment of the path
  into two shorter ones. So only chosen paths are ever written out.
* Each chosen path is formatted as one conversation. The format is
  ``<s>`` turn ``</s>`` per turn, where a turn is ``[ROLE]`` text ``[/ROLE]``.
  Inside roles and texts every ``&``, ``<``, ``[`` and ``]`` is written as
  ``&a;``, ``&l;``, ``&s;`` and ``&e;``, so no text can form a control string, and reading back
  is exact. The loss mask is the list of spans of assistant texts.

A formatted conversation is one value, so one task holds one conversation;
everything before that is spread by message.

Null texts and roles are empty. Repeated rows are messages of their own. A
message whose parent is null or doesn't exist is a root. Messages in a reply
cycle have no root and are left out; ``orphans`` lists them. Equal turns are
ordered by role and text. An empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.common import pick
from quaybook.plans.stages import write_stage

ASSISTANT = "assistant"
ESCAPES = (("&", "&a;"), ("<", "&l;"), ("[", "&s;"), ("]", "&e;"))
MAX_ROUNDS = 40  # paths of 2**40 messages


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def reply_chain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Messages of conversations given as rows by turn: each answers the one
    before it. Columns: tree, node, parent, score, role, text."""
    w = Window.partitionBy("tree").orderBy(F.col("turn"), F.col("role"), F.col("text"))
    place = F.row_number().over(w).cast("long")
    return (pick(rows, tree=conv, turn=turn, role=role, text=text).withColumn("node", place)
            .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    F.lit(0.0).alias("score"), "role", "text"))


def _lifts(messages: DataFrame) -> list[DataFrame]:
    """Table r: (tree, node, up, worth) of the messages that have an ancestor
    2**r steps up, with the sum of the scores from the node up to, not with,
    that ancestor. Tables shrink with r: only messages at least that deep are
    in it. Messages under a reply cycle never run out of ancestors; the round
    that loses no row has only those left, and ends the list."""
    m = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("worth"))
    known = m.select("tree", F.col("node").alias("parent"))
    tables = [write_stage(m.join(known, ["tree", "parent"], "left_semi")
                          .select("tree", "node", F.col("parent").alias("up"), "worth"), "lift")]
    n = tables[0].count()
    while n and len(tables) < MAX_ROUNDS:
        below, above = tables[-1], tables[-1].select("tree", F.col("node").alias("up"), F.col("up").alias("up2"),
                                                     F.col("worth").alias("worth2"))
        new = write_stage(below.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("worth") + F.col("worth2")).alias("worth")), "lift")
        before, n = n, new.count()
        if n in (0, before):
            break
        tables.append(new)
    return tables


def _to_roots(nodes: DataFrame, tables: list[DataFrame], messages: DataFrame) -> DataFrame:
    """(tree, node, root, depth, total) of the nodes (tree, node) that a root
    reaches: from the longest jump to the shortest, each is taken if there."""
    now = nodes.select("tree", "node", F.col("node").alias("at"), F.lit(0).cast("long").alias("depth"), F.lit(0.0).alias("total"))
    for r in range(len(tables) - 1, -1, -1):
        step = tables[r].select("tree", F.col("node").alias("at"), "up", "worth")
        now = now.join(step, ["tree", "at"], "left").select(
            "tree", "node", F.coalesce("up", "at").alias("at"),
            (F.col("depth") + F.when(F.col("up").isNull(), 0).otherwise(2 ** r)).alias("depth"),
            (F.col("total") + F.coalesce("worth", F.lit(0.0))).alias("total"))
    with_parent = tables[0].select("tree", F.col("node").alias("at"))
    own = messages.select("tree", F.col("node").alias("at"), F.coalesce("score", F.lit(0.0)).alias("own"))
    return (now.join(with_parent, ["tree", "at"], "left_anti").join(own, ["tree", "at"])
            .select("tree", "node", F.col("at").alias("root"), "depth", (F.col("total") + F.col("own")).alias("total")))


def chosen_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, root, branch, place, node): the messages of the ``top`` best
    branches of each tree, place 0 being the root. Null tree ids are one tree."""
    m = messages.withColumn("tree", F.struct(F.col("tree").alias("id")))
    tables = _lifts(m)
    inner = tables[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = _to_roots(m.select("tree", "node").join(inner, ["tree", "node"], "left_anti"), tables, m)
    rank = Window.partitionBy("tree", "root").orderBy(F.desc("total"), F.desc("depth"), "node")
    best = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= top)
    # Segments of chosen paths by their low end. Each round cuts those longer than its jump in two.
    path = write_stage(best.select("tree", "root", "branch", "node", F.lit(0).cast("long").alias("from"),
                                   F.col("depth").alias("place")), "path")
    for r in range(len(tables) - 1, -1, -1):
        step = tables[r].select("tree", "node", F.col("up").alias("mid"))
        middle = F.col("place") - 2 ** r
        path = write_stage(
            path.join(step, ["tree", "node"], "left")
            .select("tree", "root", "branch", F.explode(F.when(middle >= F.col("from"), F.array(
                F.struct(F.col("node"), (middle + 1).alias("from"), F.col("place")),
                F.struct(F.col("mid").alias("node"), F.col("from"), middle.alias("place"))))
                .otherwise(F.array(F.struct("node", "from", "place")))).alias("s"))
            .select("tree", "root", "branch", "s.node", "s.from", "s.place"), "path")
    return path.select(F.col("tree.id").alias("tree"), "root", "branch", "place", "node")


def orphans(messages: DataFrame) -> DataFrame:
    """(tree, node) of messages that no root reaches (reply cycles)."""
    m = messages.withColumn("tree", F.struct(F.col("tree").alias("id")))
    reached = _to_roots(m.select("tree", "node"), _lifts(m), m)
    return m.select("tree", "node").join(reached, ["tree", "node"], "left_anti").select(F.col("tree.id").alias("tree"), "node")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>["), role, F.lit("]"), text, F.lit("[/"), role, F.lit("]</s>"))


def format_conversations(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, branch, formatted, loss_spans) per chosen path. ``loss_spans``
    holds (start, end) code points of the assistant texts in ``formatted``.
    ``messages``: tree, node, parent, score, role, text; nodes are unique in
    their tree."""
    paths = chosen_paths(messages, top).withColumnRenamed("tree", "id")
    texts = messages.select(
        F.col("tree").alias("id2"), F.col("node").alias("node2"),
        escape(F.coalesce("role", F.lit(""))).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"),
        (F.coalesce("role", F.lit("")) == ASSISTANT).alias("learn"))
    turns = (paths.join(texts, paths["id"].eqNullSafe(texts["id2"]) & (paths["node"] == texts["node2"]))
             .select("id", "root", "branch", "place", "learn", _turn(F.col("role"), F.col("text")).alias("turn"),
                     (F.length("role") + 5).alias("lead"), F.length("text").alias("size")))
    lined = (turns.groupBy("id", "root", "branch")
             .agg(F.array_sort(F.collect_list(F.struct("place", "turn", "learn", "lead", "size"))).alias("t")))
    # Where each turn starts: running sums of the turns' lengths.
    ends = F.aggregate("t", F.array(F.lit(0).cast("long")),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x["turn"]))))
    spans = F.transform(F.arrays_zip("t", F.slice("ends", 1, F.size("t")).alias("starts")), lambda x: F.struct(
        x["t"]["learn"].alias("learn"), (x["starts"] + x["t"]["lead"]).alias("start"),
        (x["starts"] + x["t"]["lead"] + x["t"]["size"]).alias("end")))
    return (lined.withColumn("ends", ends)
            .select(F.col("id").alias("tree"), "root", "branch",
                    F.concat_ws("", F.transform("t", lambda x: x["turn"])).alias("formatted"),
                    F.transform(F.filter(spans, lambda s: s["learn"]),
                                lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn of a formatted conversation."""
    parts = F.filter(F.split(formatted, "</s>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 5, 2**31 - 1), "]", 1)).alias("role"),
        unescape(F.substring_index(F.substr(p, F.length(F.substring_index(p, "]", 1)) + 2), "[/", 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))))
