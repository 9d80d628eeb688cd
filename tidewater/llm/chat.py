r"""Chat formatting: reply trees, the best branches per tree (one by default), each formatted with a loss mask.

Messages form trees (``tree, node, parent``). Pointer-doubling self-joins give every message its root
distance and the score of its branch in log2(depth) rounds; the best leaf of each tree is one partial
aggregate, more leaves than one are ranked in a window; a second run through the stored jump tables enumerates the chosen root-to-leaf paths. Ids, not
texts, move in those rounds; texts join once at the end.

Template: ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts, ``<`` + backslashes + ``|`` gets one more
backslash, so no control string can occur in a text and one backslash less restores it. In roles, backslash
and newline are escaped. The loss mask lists spans (start, chars in code points) of assistant texts.

Defined results: NULL text or role is empty; a NULL tree id is a tree of its own; a message whose parent is
missing is a root; messages in a reply cycle are on no root-to-leaf path and are left out; ties between branches go to the smaller
leaf id; an empty table gives no rows; other columns are ignored. One conversation is one output string by
definition, so its turns meet in one task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stage

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "\n", r"\\n"))


def unescape_role(c: Column) -> Column:
    # Read from the left, doubled backslashes come first: between them every backslash begins a newline.
    parts = F.transform(F.split(unescape(c), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def turns_as_tree(turns: DataFrame) -> DataFrame:
    """A linear conversation is a chain: each turn replies to the one before (ties by role, then text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"))
         .withColumn("node", F.row_number().over(w).cast("long")))
    return t.select(F.col("conv_id").alias("tree"), "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score"))


def best_paths(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """(key, node, depth, rank) of the messages on the ``paths`` best-scored root-to-leaf paths of each tree (None: all).

    Depth 0 is the root, rank 1 the best path. A branch's score is the sum of its messages' scores (NULL counts as 0).
    """
    ids = messages.select("key", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = ids.select("key", F.col("node").alias("parent"), F.lit(True).alias("known")).distinct()
    ids = (ids.join(known, ["key", "parent"], "left")
           .select("key", "node", F.when(F.col("known"), F.col("parent")).alias("up"),
                   F.when(F.col("known"), F.lit(1)).otherwise(0).alias("depth"), F.col("score").alias("sum")))
    jump = stage(ids.dropDuplicates(["key", "node"]))
    jumps = []
    span, n_nodes = 1, None
    while jump.where(F.col("up").isNotNull()).limit(1).count():
        if n_nodes is None:
            n_nodes = jump.groupBy("key").count().agg(F.max("count")).first()[0]
        if span > n_nodes:  # longer than any tree: what still points up is in a cycle
            break
        jumps.append(jump.select("key", "node", "up"))
        above = jump.select("key", F.col("node").alias("up"), F.col("up").alias("up2"),
                            F.col("depth").alias("depth2"), F.col("sum").alias("sum2"))
        rooted, going = jump.where(F.col("up").isNull()), jump.where(F.col("up").isNotNull())
        going = going.join(above, ["key", "up"]).select(
            "key", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"),
            (F.col("sum") + F.col("sum2")).alias("sum"))
        jump = stage(rooted.unionByName(going))
        span *= 2
    done = jump.where(F.col("up").isNull())
    first = jumps[0] if jumps else jump
    parents = first.where(F.col("up").isNotNull()).select("key", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["key", "node"], "left_anti")
    if paths == 1:
        best = leaves.groupBy("key").agg(F.max(F.struct("sum", -F.col("node"), F.col("depth"))).alias("b"))
        path = best.select("key", (-F.col("b.col2")).alias("node"), F.col("b.depth").alias("depth"),
                           F.lit(1).alias("rank"))
    else:
        order = Window.partitionBy("key").orderBy(F.desc("sum"), "node")
        path = leaves.withColumn("rank", F.row_number().over(order)).select("key", "node", "depth", "rank")
        path = path if paths is None else path.where(F.col("rank") <= paths)
    for i in range(len(jumps) - 1, -1, -1):  # each round doubles the path: the message 2**i above every known one
        path = stage(path)
        up = (path.join(jumps[i], ["key", "node"]).where(F.col("up").isNotNull())
              .select("key", F.col("up").alias("node"), (F.col("depth") - (1 << i)).alias("depth"), "rank"))
        path = path.unionByName(up)
    return path


def format_trees(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """One row per tree: ``tree``, ``formatted`` and ``loss`` (array of (start, chars) in code points).

    With ``paths`` other than 1, one row for each of the tree's so many best branches (None: all), and its ``rank``.
    """
    m = messages.withColumn("key", F.coalesce(F.col("tree").cast("string"), F.lit("")))
    m = m.withColumn("key", F.concat(F.when(F.col("tree").isNull(), "n").otherwise("t"), "key"))
    m = m.select("key", "tree", "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text"))
    m = stage(m)
    turns = best_paths(m, paths).join(m, ["key", "node"])
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = (turns.withColumn("head", head).withColumn("body", escape(F.col("text")))
             .withColumn("piece", F.concat("head", "body", F.lit(END + "\n"))))
    before = Window.partitionBy("key", "rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    span = F.when(F.col("role") == LOSS_ROLE,
                  F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").alias("chars")))
    rows = turns.groupBy("key", "rank").agg(
        F.first("tree").alias("tree"),
        F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("loss"))
    return rows.select("tree", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss",
                       *(["rank"] if paths != 1 else []))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    inner = lambda p: F.substr(p, F.lit(len(START) + 1))
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.substring_index(inner(p), "\n", 1)).alias("role"),
        unescape(F.substr(inner(p), F.instr(inner(p), "\n") + 1)).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"),
                                                                      s["chars"]))), "")
