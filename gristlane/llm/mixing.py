"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Rows of a source, in hash order, form blocks.  A source's target weight w is a fraction of whole
numbers that sum to the total, so that the weights sum to 1.  Block j (from 0) of a source is released
at floor(j / w) and due at ceil((j + 1) / w); earliest-deadline-first gives each slot the released block
that is due first, ties to the source of the smaller name.  Every block meets its window, so at any slot
a source is off its target by less than one block.

Slots are dealt in ranges, each a row of its own.  A range is first dealt alone, to the blocks released
in it.  What is pending when a range begins, one block a source at most, may take any of its slots: of
the pending blocks and those that the range alone has dealt, those due first stay, and the rest goes on.
So only the pending blocks, not the slots, run through all ranges; then every range is dealt from its
true beginning, and the result is that of one pass over all slots.  When a source is used up its slots
are left out; the others keep their order.  Where only one source is left, its blocks stand at the ends
of their windows.

Defined cases: rows of a null source are a source of their own; rows that repeat an id are rows of
their own, in any order among equal ones; an empty table gives an empty result; columns of the added
names are replaced, other columns are kept, whatever their names; weights of unknown sources are
ignored, sources without a weight take the least weight given; weights are fractions of about 2 ** 30,
of which each source has one at least.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from ..session import materialize
from .sizes import small

#: finer runs of a source's rows that are numbered apart, so that a large source is many tasks
RUNS = 1024
#: about the sum of the whole numbers that stand for weights; products of two of them fit 64 bits
SCALE = 1 << 30
#: ranges that are listed at once before they are dealt to tasks
CHUNK = 32
#: ranges through which pending blocks are passed on at once
PASS = 2048


def _down(n: str, a: str, b: str) -> str:
    """floor(n * a / b) in whole numbers, without the product."""
    return f"(({n}) div ({b}) * ({a}) + ({n}) % ({b}) * ({a}) div ({b}))"


def _up(n: str, a: str, b: str) -> str:
    """ceil(n * a / b) in whole numbers, without the product."""
    return f"(({n}) div ({b}) * ({a}) + (({n}) % ({b}) * ({a}) + ({b}) - 1) div ({b}))"


def _release(j: str, a: str) -> str:
    return _down(j, "total", a)


def _due(j: str, a: str) -> str:
    return _up(f"{j} + 1", "total", a)


def targets(counts: DataFrame, weights: dict | None, power: float, block: int) -> DataFrame:
    """One row: arrays over the sources, by name, of source, whole weight a and number of blocks; and the weights' total."""
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in (str(kv[0]), float(kv[1]))])
        weight = F.coalesce(F.try_element_at(table, F.coalesce("source", F.lit(""))), F.lit(float(min(weights.values()))))
    else:
        weight = F.pow(F.col("rows").cast("double"), F.lit(float(power)))
    named = F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "source", "rows", weight.alias("weight"))
    one = counts.agg(F.sort_array(F.collect_list(named)).alias("s")).where("size(s) > 0")
    one = one.withColumn("sum", F.expr("aggregate(s, 0D, (p, x) -> p + greatest(x.weight, 0D))"))
    one = one.withColumn("a", F.expr(f"transform(s, x -> greatest(1L, cast(round(x.weight * {SCALE} / nullif(sum, 0D)) as bigint), 1L))"))
    one = one.withColumn("blocks", F.expr(f"transform(s, x -> cast((x.rows + {block - 1}) div {block} as bigint))"))
    return one.select(F.expr("transform(s, x -> x.source)").alias("sources"), "a", "blocks", F.expr("aggregate(a, 0L, (p, x) -> p + x)").alias("total"))


def _edf(first: str, keep: str, out: str) -> str:
    """Expression over a range's slots: earliest deadline first from ``first`` (the next block of each source); ``keep`` builds the struct of what is kept (field x), ``out`` is its start."""
    due = f"named_struct('due', {_due('j', 'get(a, i)')}, 'i', i)"
    pick = f"array_min(filter(transform(acc.done, (j, i) -> if({_release('j', 'get(a, i)')} <= now, {due}, null)), x -> x is not null)).i"
    # the pick as a variable of a one-element array, so that it is computed once
    step = f"get(transform(array({pick}), p -> named_struct('done', transform(acc.done, (j, i) -> if(i = p, j + 1, j)), 'x', {keep})), 0)"
    return f"aggregate(sequence(at, until - 1), named_struct('done', {first}, 'x', {out}), (acc, now) -> {step})"


def ranges(plan: DataFrame, span: int, parts: int) -> DataFrame:
    """plan for each range r of slots, from slot ``at`` up to ``until``, and what it does alone.

    ``room``: slots that are left for pending blocks and for those dealt alone that are due later
    (``late``); ``left``: blocks released in the range that are due later and not dealt.  The last range
    (r = last) begins where all sources but the ``tail`` have ended.
    """
    one = plan.withColumn("ends", F.expr(f"transform(a, (x, i) -> {_due('get(blocks, i) - 1', 'x')})"))
    one = one.withColumn("tail", F.expr("cast(array_position(ends, array_max(ends)) - 1 as int)"))
    one = one.withColumn("last", F.expr(f"(coalesce(get(sort_array(ends, false), 1), 0L) + {span - 1}) div {span}")).drop("ends")
    rows = one.withColumn("chunk", F.explode(F.expr(f"sequence(0L, last div {CHUNK})"))).repartition(parts, "chunk")
    rows = rows.withColumn("r", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(last, chunk * {CHUNK} + {CHUNK - 1}))"))).drop("chunk")
    rows = rows.withColumn("at", F.expr(f"r * {span}")).withColumn("until", F.expr(f"r * {span} + {span}"))
    # blocks released before the range, and before its end: those of a range alone lie between
    rows = rows.withColumn("first", F.expr(f"transform(a, x -> {_up('at', 'x', 'total')})")).withColumn("next", F.expr(f"transform(a, x -> {_up('until', 'x', 'total')})"))
    rows = rows.withColumn("alone", F.expr(f"if(r < last, {_edf('first', 'acc.x', 'true')}.done, first)"))
    late = f"transform(alone, (j, i) -> named_struct('due', {_due('get(next, i) - 1', 'get(a, i)')}, 'i', i, 'dealt', j = get(next, i), 'own', get(next, i) > get(first, i)))"
    rows = rows.withColumn("late", F.expr(f"filter({late}, x -> x.own and x.due > until)"))
    pick = lambda dealt: F.expr(f"transform(filter(late, x -> x.dealt = {dealt}), x -> named_struct('due', x.due, 'i', x.i))")
    rows = rows.withColumns({"left": pick("false"), "late": pick("true")})
    done = "aggregate(zip_with(alone, first, (x, y) -> x - y), 0L, (p, x) -> p + x)"
    return rows.withColumn("room", F.expr(f"until - at - {done} + size(late)")).drop("next", "alone")


def pending(state: DataFrame, count: int) -> DataFrame:
    """r and the sources whose latest released block is pending when range r begins; the blocks themselves pass through the ranges, so many ranges a pass."""
    kind = "array<struct<due:bigint, i:int>>"
    carried, out = f"cast(array() as {kind})", None
    met = "sort_array(concat(acc.now, x.late))"
    went = "concat(if(size(m) > x.room, slice(m, cast(x.room as int) + 1, size(m)), cast(array() as " + kind + ")), x.left)"
    step = f"get(transform(array({met}), m -> named_struct('now', {went}, 'out', concat(acc.out, array(named_struct('r', x.r, 'i', transform(acc.now, y -> y.i)))))), 0)"
    for lo in range(0, max(count, 1), PASS):
        some = state.where((F.col("r") >= lo) & (F.col("r") < lo + PASS)).agg(F.sort_array(F.collect_list(F.struct("r", "room", "late", "left"))).alias("s"))
        acc = f"aggregate(s, named_struct('now', {carried}, 'out', cast(array() as array<struct<r:bigint, i:array<int>>>)), (acc, x) -> {step})"
        one = materialize(some.select(F.expr(acc).alias("x")).select("x.*"), "pending")
        if lo + PASS < count:  # a block a source at most
            rest = one.select("now").first()["now"]
            carried = f"cast(array({', '.join(f'named_struct(\'due\', {b.due}L, \'i\', {b.i})' for b in rest)}) as {kind})"
        each = one.select(F.explode("out").alias("x")).select("x.r", F.col("x.i").alias("waiting"))
        out = each if out is None else out.unionByName(each)
    return out


def slots(state: DataFrame) -> DataFrame:
    """source, block_no, slot and position of the blocks of all ranges but the last."""
    keep, empty = "concat(acc.x, array(named_struct('i', p, 'j', get(acc.done, p), 'slot', now)))", "cast(array() as array<struct<i:int, j:bigint, slot:bigint>>)"
    dealt = state.where("r < last").withColumn("picks", F.expr(_edf("start", keep, empty) + ".x"))
    dealt = dealt.withColumn("before", F.expr("aggregate(zip_with(start, blocks, (x, y) -> least(x, y)), 0L, (p, x) -> p + x)"))
    flat = dealt.select("sources", "before", F.posexplode(F.expr("filter(picks, x -> x.j < get(blocks, x.i))")).alias("pos", "x"))
    return flat.select(F.expr("get(sources, x.i)").alias("source"), F.col("x.j").alias("block_no"), F.col("x.slot").alias("slot"), (F.col("before") + F.col("pos")).alias("position"))


def schedule(docs: DataFrame, weights: dict | None = None, power: float = 0.7, block: int = 16, span: int = 256) -> DataFrame:
    """docs with block_no (of its source), place in it, slot and position (rank among all blocks), release and due.

    Sort by position, then place, to read the mixture.  ``weights`` are by source; without them a
    source weighs its number of rows to the ``power``.  ``span``: slots of a range.
    """
    added = ["block_no", "place", "slot", "position", "release", "due"]
    columns = [c for c in docs.columns if c not in added]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc"))
    key = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    # runs by the first hex digits: rows of a run are neighbours in hash order
    rows = docs.withColumn("_key", key).withColumn("_run", F.expr(f"cast(conv(substring(_key, 1, 4), 16, 10) as int) div {65536 // RUNS}").cast("int"))
    runs = materialize(rows.groupBy("source", "_run").agg(F.count("*").alias("n")), "runs")  # RUNS rows a source at most
    before = runs.withColumn("_before", F.sum("n").over(Win.partitionBy("source").orderBy("_run").rowsBetween(Win.unboundedPreceding, -1)))
    before = before.select(F.col("source").alias("_s"), F.col("_run").alias("_r"), F.coalesce("_before", F.lit(0)).alias("_before"))
    plan = materialize(targets(runs.groupBy("source").agg(F.sum("n").alias("rows")), weights, power, block), "targets")
    state = materialize(ranges(plan, span, parts), "ranges")
    waiting = small(materialize(pending(state, state.count()), "waiting"))
    state = state.join(waiting, "r").withColumn("start", F.expr("transform(first, (x, i) -> x - if(array_contains(waiting, i), 1L, 0L))"))
    state = materialize(state.drop("first", "late", "left", "room", "waiting"), "states")
    blocks = materialize(slots(state), "slots").select(F.col("source").alias("_b"), F.col("block_no").alias("_no"), "slot", "position")
    # for each source its weight; for the tail the first block that no range holds and its position
    end = state.where("r = last").withColumn("done", F.expr("aggregate(zip_with(start, blocks, (x, y) -> least(x, y)), 0L, (p, x) -> p + x)"))
    each = end.select("sources", "total", "tail", "start", "done", F.posexplode("a").alias("i", "a"))
    each = each.select(F.expr("get(sources, i)").alias("_t"), "a", "total", F.expr("if(i = tail, get(start, i), null)").alias("_from"), "done")

    own = Win.partitionBy("source", "_run").orderBy("_key", "doc_id")
    out = rows.withColumn("_rn", F.row_number().over(own) - 1)
    out = out.join(before, out["source"].eqNullSafe(F.col("_s")) & (out["_run"] == F.col("_r"))).withColumn("_nr", F.col("_before") + F.col("_rn"))
    out = out.withColumn("block_no", F.expr(f"cast(_nr div {block} as bigint)")).withColumn("place", F.expr(f"cast(_nr % {block} as int)"))
    out = out.join(small(each), out["source"].eqNullSafe(F.col("_t")))
    out = out.join(small(blocks), out["source"].eqNullSafe(F.col("_b")) & (out["block_no"] == F.col("_no")), "left")
    out = out.withColumn("release", F.expr(_release("block_no", "a"))).withColumn("due", F.expr(_due("block_no", "a")))
    out = out.withColumn("slot", F.coalesce("slot", F.col("due") - 1)).withColumn("position", F.coalesce("position", F.col("done") + F.col("block_no") - F.col("_from")))
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in columns], *added)
