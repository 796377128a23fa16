"""Chat formatting of reply trees.

Method. A tree's nodes point to their parents. Root-to-leaf paths are enumerated by
iterative self-joins that double their reach: after round r every node knows its
2**r-th ancestor and the score and length of the path in between, so a tree of depth d takes log2(d)
rounds, of narrow rows only; a node that has reached its root takes no further part but as an ancestor. Leaves carry the path's mean score; the best ``paths_per_tree`` leaves of each
tree are chosen (ties: longer path, then smaller node id). The chosen paths are written out by
the same ancestor tables, from the longest jump to the shortest, then joined to the texts once and
formatted as one conversation each.

Template. A turn is ``open(role) + text + close(role)``: ``<<SYS>>..<</SYS>>`` (system),
``[INST] .. [/INST]`` (user), ``<s>..</s>`` (assistant) and ``<<ROLE:name>>..<</ROLE>>`` for other roles. In texts, a
control string gets a backslash after its first character, and one more if there are some already, so
formatted texts hold no control string of their own and removing one backslash gives the text back. The
loss mask is the list of (start, end) of the assistant texts in the formatted string, in code points, escapes included.

Null text or role: empty. Equal (tree, node) rows: the one with the smallest (role, text) counts as the node
and the others are its repeats, kept as turns right after it. A parent that does not exist makes a root; nodes
on a cycle have no leaf and are left out. Null tree or node ids are left out. Very long texts: formatted whole, one row each. Other columns,
whatever their names: ignored. Empty table: empty results. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.frames import narrowed, stored

#: Control strings, as a regular expression for both Java and RE2: first character, backslashes, rest.
CONTROL = r"(<|\[)(\\*)(<SYS>>|</SYS>>|<ROLE:|</ROLE>>|INST\] ?|/INST\]|s>|/s>)"
ESCAPED = r"(<|\[)\\(\\*)(<SYS>>|</SYS>>|<ROLE:|</ROLE>>|INST\] ?|/INST\]|s>|/s>)"
TURN = r"(?s)(<<SYS>>|\[INST\] |<s>|<<ROLE:[^>]*>>)(.*?)(<</SYS>>| \[/INST\]|</s>|<</ROLE>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def opening(role: Column) -> Column:
    return (F.when(role == "system", "<<SYS>>").when(role == "user", "[INST] ").when(role == "assistant", "<s>")
            .otherwise(F.concat(F.lit("<<ROLE:"), F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(">"), F.lit("%3E")),
                                                            F.lit("<"), F.lit("%3C")), F.lit(">>"))))


def closing(role: Column) -> Column:
    return (F.when(role == "system", "<</SYS>>").when(role == "user", " [/INST]").when(role == "assistant", "</s>")
            .otherwise("<</ROLE>>"))


def role_of(mark: Column) -> Column:
    name = F.substring(mark, F.lit(8), F.length(mark) - 9)
    name = F.replace(F.replace(F.replace(name, F.lit("%3C"), F.lit("<")), F.lit("%3E"), F.lit(">")), F.lit("%25"), F.lit("%"))
    return (F.when(mark == "<<SYS>>", "system").when(mark == "[INST] ", "user").when(mark == "<s>", "assistant").otherwise(name))


def reply_paths(nodes: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """tree, leaf, node, place (0 at the root) of the chosen paths.

    nodes: tree, node, parent (null at a root), score; one row per (tree, node).
    """
    key = ["tree", "node"]

    def ended(table):
        return table.where("up is null")

    known = nodes.select(F.col("tree"), F.col("node").alias("parent")).withColumn("there", F.lit(True))
    start = (nodes.join(known, ["tree", "parent"], "left")
             .select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"),
                     F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.lit(1).cast("long").alias("length")))
    now = stored(start, "tree-0")
    jumps = [now]  # jumps[r]: up is the 2**r-th ancestor, null where the root is nearer; only nodes that were not there before
    total = now.count()
    while now.where("up is not null").limit(1).count() and 2 ** (len(jumps) - 1) <= total:
        above = (reduce(DataFrame.union, [ended(t) for t in jumps], now.where("up is not null"))
                 .select("tree", F.col("node").alias("up"), F.col("up").alias("far"),
                         F.col("score").alias("more"), F.col("length").alias("longer")))
        now = stored(now.where("up is not null").join(above, ["tree", "up"], "left")
                     .select("tree", "node", F.col("far").alias("up"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
                             (F.col("length") + F.coalesce("longer", F.lit(0))).alias("length")), f"tree-{len(jumps)}")
        jumps.append(now)
    parents = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reduce(DataFrame.union, [ended(t) for t in jumps]).join(parents, key, "left_anti").withColumn("mean", F.col("score") / F.col("length"))
    best = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("length"), "node"))
    if paths_per_tree == 1:
        chosen = (leaves.groupBy("tree").agg(F.max_by(F.struct("node", "length"), F.struct("mean", "length", -F.col("node"))).alias("b"))
                  .select("tree", F.col("b.node").alias("leaf"), F.col("b.node").alias("node"), F.col("b.length").alias("length")))
    else:
        chosen = (leaves.withColumn("best", best).where(F.col("best") <= paths_per_tree)
                  .select("tree", F.col("node").alias("leaf"), "node", "length"))
    path = stored(chosen.select("tree", "leaf", "node", (F.col("length") - 1).alias("place")), "path")
    for r in range(len(jumps) - 1, -1, -1):
        up = jumps[r].where("up is not null").select("tree", "node", "up")
        further = (path.join(up, key).select("tree", "leaf", F.col("up").alias("node"), (F.col("place") - 2 ** r).alias("place")))
        path = stored(path.union(further), f"path-{r}")
    return path


def format_paths(turns: DataFrame) -> DataFrame:
    """One row per (tree, leaf): n_turns, formatted, loss_spans. turns: tree, leaf, place, role, text (place orders; ties by role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct("place", role.alias("role"), text.alias("text"))
    gathered = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    piece = F.transform("turns", lambda t: F.struct(opening(t["role"]).alias("open"), escape(t["text"]).alias("body"),
                                                    closing(t["role"]).alias("close"), (t["role"] == "assistant").alias("loss")))
    pieces = gathered.select("tree", "leaf", F.size("turns").cast("long").alias("n_turns"), piece.alias("pieces"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, p):
        start = state["at"] + F.length(p["open"])
        end = start + F.length(p["body"])
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct((end + F.length(p["close"])).cast("int").alias("at"),
                        F.when(p["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return pieces.select(
        "tree", "leaf", "n_turns",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["open"], p["body"], p["close"])), "").alias("formatted"),
        F.aggregate("pieces", nothing, step, lambda s: s["spans"]).alias("loss_spans"))


def parsed_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    parts = [F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (1, 2)]
    return F.transform(F.arrays_zip(parts[0].alias("mark"), parts[1].alias("body")),
                       lambda t: F.struct(role_of(t["mark"]).alias("role"), unescape(t["body"]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def op4_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations as reply trees of one path each, and conversation -7: digests read back from the formatted strings."""
    rows = narrowed(spark.read.parquet(f"{sf_dir}/conversations.parquet"), tree="conv_id", turn="turn", role="role", text="text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    rows = rows.union(own)
    order = Window.partitionBy("tree").orderBy("turn")
    nodes = (rows.groupBy("tree", "turn").agg(F.max(F.length("text")).alias("score"))
             .select("tree", F.col("turn").alias("node"), F.lag("turn").over(order).alias("parent"), "score"))
    path = reply_paths(nodes)
    turns = (rows.withColumnRenamed("turn", "node").join(path, ["tree", "node"]).select("tree", "leaf", "place", "role", "text"))
    out = stored(format_paths(turns), "chat")
    back = parsed_turns(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return (out.select("*", back.alias("turns"), loss.alias("loss"))
            .select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
                    .alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
told AS (
  SELECT *, length(text)
    + length(regexp_replace(text, '(<|\[)(\\*)(<SYS>>|</SYS>>|<ROLE:|</ROLE>>|INST\] ?|/INST\]|s>|/s>)', '\1\\\2\3', 'g')) - length(text)
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 18 + length(role) END AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM told WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id
"""
