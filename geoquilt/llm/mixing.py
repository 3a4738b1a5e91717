"""Mixing sources to target weights by weighted fair queueing.

Each source's documents queue in a shuffled order, pass after pass; a document's virtual finish
time is the source's words up to its end, divided by the source's target. All passes of all
documents are then sorted by finish time and cut off at the total budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, weight, target) for the sources ``(source, source_size)``.

    Sources in code-point order, null last, take the weights in turn and share the sum of all
    sizes by them. No target is above ``most`` times its source's size: what is above goes to the
    others by weight. A source is at its limit if the common level, target for each unit of weight,
    is at least its limit for each unit; so with sources in order of that ratio, the level follows
    from running sums and needs no repeated passes. Empty sources have target 0.
    The table has one row for each source.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.row_number().over(place) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))).cast("int") + 1)
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("limited", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("heavier", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    everything = Window.partitionBy()
    level_of_rest = (F.sum("source_size").over(everything) - F.col("limited")) / F.col("heavier")
    # Taking out sources at their limits raises the level, taking out others lowers it: the highest is the one.
    level = F.max("level").over(everything)
    return rows.withColumn("level", level_of_rest).select("source", "source_size", "weight", F.least(F.col("limit"), F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken, times) for every document.

    size counts words, null texts have none; times is how often the mix takes the document, at most
    ``most``, and taken the words that makes. Documents without words are taken as often as their
    source goes round in full. Null is a source of its own; null ids and repeated rows are documents
    like others (tied ones may change places, which changes nothing). An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = common.written(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = common.written(targets(sources, weights, most), "targets")
    start = Window.orderBy(F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    goals = goals.withColumn("words_before", F.coalesce(F.sum("source_size").over(start), F.lit(0)))
    rows = rows.withColumn("turn", F.xxhash64(F.col("doc_id"), F.lit(seed)))
    order = [F.col("source").isNull(), F.col("source"), F.col("turn"), F.col("doc_id"), F.col("size")]
    queued = common.running_total(rows, order, "size", "words_to", "queue")
    goal = goals.withColumnRenamed("source", "goal_source")
    queued = queued.join(common.small_or_not(goal), F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    finish = [(F.col("words_to") - F.col("words_before") + k * F.col("source_size")) / F.col("target") for k in range(most)]
    queued = common.written(queued.withColumn("finish", F.when(F.col("target") > 0, F.array(*finish)).otherwise(F.array())), "finish")
    # All passes, at most ``most`` for each document: which of them the budget reaches is known only in their common order.
    passes = queued.select("doc_id", "turn", "size", F.explode("finish").alias("at"))
    total = queued.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    sums = common.running_total(passes, [F.col("at"), F.col("turn"), F.col("doc_id"), F.col("size")], "size", "words_so_far", "passes")
    cut = sums.crossJoin(F.broadcast(total)).where("words_so_far <= budget").agg(F.max(F.struct("at", "turn", "doc_id")).alias("cut"))
    times = F.size(F.filter("finish", lambda at: F.struct(at.alias("at"), F.col("turn"), F.col("doc_id")) <= F.col("cut")))
    out = queued.crossJoin(F.broadcast(cut)).withColumn("times", F.coalesce(F.when(F.col("cut").isNull(), 0).otherwise(times), F.lit(0)))
    return out.select("doc_id", "size", "source", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"), F.col("times").cast("int").alias("times"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them, with all their columns, whatever these are called.

    Rows without an id are told apart by text and source. Rows that share an id all come as often as
    the one of them that is taken most. An empty table gives no rows.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col, source_col))
    rows = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = rows.select("key", F.col(f"row.`{text_col}`").alias("text"), F.col(f"row.`{source_col}`").alias("source"))
    times = mix(taken, weights, most, seed, "key", "text", "source").where("times > 0").groupBy(F.col("doc_id").alias("key")).agg(F.max("times").alias("times"))
    times = common.written(times, "times")
    turns = rows.join(common.small_or_not(times), "key").select("row", F.explode(F.sequence(F.lit(1), "times")).alias("turn"))
    return turns.select(*[F.col(f"row.`{c}`") for c in docs.columns])
