"""Quotation linking for message threads, in DataFrame functions only.

Lines that begin with ``>`` are quoted, one level for each mark.  Runs of lines of one level, cut at
blank lines, are passages.  The hash of a passage (and of each of its lines), without regard to case
and white space, is joined to the first message of the conversation in which it stands unquoted.
A message replies to the latest message that it quotes at the first level; following replies gives
the root of its thread.  What remains of a message is its text without quotes, and without the line
that announces one ("... wrote:").

Conversations are built in reply order: a message, then each of its replies by turn, every one followed
by its own replies.  A message's place is a sum along the way to its root, of the messages that stand
before each step; sums and sizes are found by doubling, so a conversation of any size or depth needs no
row or task that holds it.

Defined cases: a null text is empty; a message that quotes nothing found begins a thread; a quote of
a later or the same turn is not a link; of messages that share a turn all are linked as one, and stand
together by role and text; rows of a null conversation or turn are never linked, and each is a
conversation of its own; blank passages are no passages; an empty table gives an empty result; other
columns than the four that are read are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from ..session import materialize
from .decontam import let

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
CUT = "\x01"


def _lines(text: Column) -> Column:
    """Array of (level, content) of the lines of a text."""
    plain = F.translate(F.coalesce(text, F.lit("")), CUT + "\r", " ")
    return F.transform(F.split(plain, "\n"), lambda x: let(F.regexp_extract(x, MARKS, 1), lambda m: F.struct(F.length(F.regexp_replace(m, "[^>]", "")).alias("level"), F.regexp_replace(x, MARKS, "").alias("content"))))


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _passages(lines: Column) -> Column:
    """Array of (level, text) of the passages: runs of lines of one level without a blank line."""

    def cut(x: Column, i: Column) -> Column:
        before = F.get(lines, i - 1)
        return (i == 0) | (F.trim(x["content"]) == "") | (F.trim(before["content"]) == "") | (before["level"] != x["level"])

    def build(cuts: Column) -> Column:
        texts = F.split(F.array_join(F.transform(lines, lambda x, i: F.concat(F.when(F.get(cuts, i) & (i > 0), F.lit(CUT)).when(i > 0, F.lit(" ")).otherwise(F.lit("")), x["content"])), ""), CUT)
        levels = F.transform(F.filter(lines, lambda x, i: F.get(cuts, i)), lambda x: x["level"])
        both = F.zip_with(texts, levels, lambda t, n: F.struct(n.alias("level"), normal(t).alias("text")))
        return F.filter(both, lambda p: p["text"] != "")

    return let(F.transform(lines, cut), build)


def parse(messages: DataFrame) -> DataFrame:
    """messages with reply (the text without quotes) and passages."""
    rows = messages.withColumn("_l", F.array(F.col("text"))).withColumn("_l", F.get(F.transform("_l", _lines), F.lit(0)))

    def kept(lines: Column) -> Column:
        def own(x: Column, i: Column) -> Column:
            announces = x["content"].rlike(r"(?i)\bwrote:[ \t]*$") & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
            return (x["level"] == 0) & ~announces

        return F.trim(F.regexp_replace(F.array_join(F.transform(F.filter(lines, own), lambda x: x["content"]), "\n"), r"\n{3,}", "\n\n"))

    both = let(F.col("_l"), lambda v: F.struct(kept(v).alias("reply"), _passages(v).alias("passages")))
    rows = rows.withColumn("_b", both)
    return rows.withColumn("reply", F.regexp_replace(F.col("_b.reply"), r"^\s+|\s+$", "")).withColumn("passages", F.col("_b.passages")).drop("_l", "_b")


def _doubled(state: DataFrame, sums: dict, name: str, below: str | None = None) -> DataFrame:
    """state with the columns ``sums`` added up along the way to the root, and ``below`` over all that is below a row.

    state has conv_id, turn and jump, the next turn on the way.  A round doubles the steps of a jump.
    """
    keys = ["conv_id", "turn"]
    while state.where("jump is not null").limit(1).count():
        ahead = state.select("conv_id", F.col("turn").alias("jump"), F.col("jump").alias("_jump"), *[F.col(c).alias(f"_{c}") for c in sums])
        moved = state.join(ahead, ["conv_id", "jump"], "left")
        new = {c: how(F.col(c), F.col(f"_{c}")) for c, how in sums.items()}
        if below:
            gained = state.where("jump is not null").groupBy("conv_id", F.col("jump").alias("turn")).agg(F.sum(below).alias("_below"))
            moved = moved.join(gained, keys, "left")
            new[below] = F.col(below) + F.coalesce("_below", F.lit(0))
        state = materialize(moved.select(*[F.col("_jump").alias("jump") if c == "jump" else new[c].alias(c) if c in new else F.col(c) for c in state.columns]), name)
    return state


def _added(x: Column, more: Column) -> Column:
    return x + F.coalesce(more, F.lit(0))


#: turns of a run of replies whose sizes are added up in one piece
RUN = 4096


def _places(nodes: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth and start (messages of the thread before this turn) of nodes (conv_id, turn, parent, weight)."""
    state = nodes.select("conv_id", "turn", F.col("parent").alias("jump"), F.coalesce("parent", "turn").alias("root"), F.col("parent").isNotNull().cast("long").alias("depth"), "parent", "weight", F.col("weight").alias("size"))
    tree = _doubled(state, {"root": lambda x, far: F.coalesce(far, x), "depth": _added}, "trees", "size").drop("jump")
    # sizes of earlier replies to the same turn: in runs, so that a turn of many replies is many tasks
    replies = tree.where("parent is not null").withColumn("run", F.floor(F.col("turn") / RUN))
    runs = replies.groupBy("conv_id", "parent", "run").agg(F.sum("size").alias("n"))
    ahead = Win.partitionBy("conv_id", "parent").orderBy("run").rowsBetween(Win.unboundedPreceding, -1)
    runs = runs.select("conv_id", "parent", "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    own = Win.partitionBy("conv_id", "parent", "run").orderBy("turn").rowsBetween(Win.unboundedPreceding, -1)
    replies = replies.withColumn("earlier", F.coalesce(F.sum("size").over(own), F.lit(0))).join(runs, ["conv_id", "parent", "run"])
    over = tree.select("conv_id", F.col("turn").alias("parent"), F.col("weight").alias("above"))
    steps = replies.join(over, ["conv_id", "parent"]).select("conv_id", "turn", F.col("parent").alias("jump"), (F.col("above") + F.col("ahead") + F.col("earlier")).alias("start"))
    roots = tree.where("parent is null").select("conv_id", "turn", F.lit(None).cast(nodes.schema["turn"].dataType).alias("jump"), F.lit(0).cast("long").alias("start"))
    starts = _doubled(materialize(steps.unionByName(roots), "steps"), {"start": _added}, "starts").drop("jump")
    return tree.select("conv_id", "turn", "root", "depth").join(starts, ["conv_id", "turn"])


def threads(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply, n_quotes, n_linked, parent_turn, root_turn, depth and position (from 1) of every row.

    Sort by conv_id, root_turn, position to read the conversations in reply order.
    """
    rows = parse(messages.select("conv_id", "turn", "role", "text"))
    quotes = F.filter("passages", lambda p: p["level"] > 0)
    # each line with its level: what a quote may match is a passage as a whole, or one of its lines
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: let(F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")), lambda n: F.struct(n.alias("level"), normal(F.when(n > 0, F.regexp_replace(x, MARKS, "")).otherwise(x)).alias("text")))), lambda x: x["text"] != "")
    keyed = lambda p, i: F.struct(i.alias("i"), p["level"].alias("level"), F.xxhash64(p["text"]).alias("key"))
    asks = F.array_distinct(F.concat(F.transform(quotes, keyed), F.transform(F.filter("_lines", lambda x: x["level"] > 0), lambda x: keyed(x, F.lit(-1)))))
    says = F.array_distinct(F.concat(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: F.xxhash64(p["text"])), F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: F.xxhash64(x["text"]))))
    rows = rows.withColumn("_lines", lines).select("conv_id", "turn", "role", "reply", F.size(quotes).cast("long").alias("n_quotes"), asks.alias("asks"), says.alias("says"))
    rows = materialize(rows, "parsed")
    has = rows.where("conv_id is not null and turn is not null")
    wanted = materialize(has.select("conv_id", "turn", F.explode("asks").alias("q")).select("conv_id", "turn", "q.*").distinct(), "quoted")
    # only passages that some message of the conversation quotes; the first turn of each, combined before the shuffle
    first = has.select("conv_id", "turn", F.explode("says").alias("key")).join(wanted.select("conv_id", "key").distinct(), ["conv_id", "key"], "left_semi").groupBy("conv_id", "key").agg(F.min("turn").alias("original"))
    found = wanted.join(first, ["conv_id", "key"]).where("original < turn")
    parent = found.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("level") == 1, F.col("original"))).alias("parent"), F.count_distinct(F.when(F.col("i") >= 0, F.col("i"))).alias("n_linked"))
    nodes = materialize(has.groupBy("conv_id", "turn").agg(F.count("*").alias("weight")).join(parent, ["conv_id", "turn"], "left"), "nodes")
    at = _places(nodes).join(nodes.select("conv_id", "turn", F.col("parent").alias("parent_turn"), "n_linked"), ["conv_id", "turn"])

    within = Win.partitionBy("conv_id", "turn").orderBy("role", "reply")
    placed = has.withColumn("_n", F.row_number().over(within)).join(at, ["conv_id", "turn"])
    columns = ["conv_id", "turn", "role", "reply", "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "parent_turn", F.col("root").alias("root_turn"), "depth", (F.col("start") + F.col("_n")).cast("long").alias("position")]
    none = F.lit(None).cast(rows.schema["turn"].dataType)
    alone = rows.where("conv_id is null or turn is null").select("conv_id", "turn", "role", "reply", "n_quotes", F.lit(0).cast("long").alias("n_linked"), none.alias("parent_turn"), F.col("turn").alias("root_turn"), F.lit(0).cast("long").alias("depth"), F.lit(1).cast("long").alias("position"))
    return placed.select(*columns).unionByName(alone)


def conversations(messages: DataFrame, most: int = 1000) -> DataFrame:
    """conv_id, root_turn, part, n_messages and, in reply order, turns, roles, depths and texts without quotes.

    A conversation of more than ``most`` messages goes on in the next part.
    """
    rows = threads(messages)
    one = F.struct("position", "turn", "role", "depth", "reply")
    part = F.expr(f"(position - 1) div {most}")
    linked = rows.where("conv_id is not null and turn is not null").groupBy("conv_id", "root_turn", part.alias("part")).agg(F.sort_array(F.collect_list(one)).alias("m"))
    alone = rows.where("conv_id is null or turn is null").select("conv_id", "root_turn", F.lit(0).cast("long").alias("part"), F.array(one).alias("m"))
    both = linked.unionByName(alone)
    parts = {"turns": "turn", "roles": "role", "depths": "depth", "texts": "reply"}
    return both.select("conv_id", "root_turn", "part", F.size("m").cast("long").alias("n_messages"), *[F.expr(f"transform(m, x -> x.{c})").alias(name) for name, c in parts.items()])
