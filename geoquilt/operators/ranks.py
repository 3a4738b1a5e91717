"""Values at ranks of a column, of all rows or of each key: equal values are counted, counts are range-partitioned, no task holds a column or a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import scratch

#: Rows of a table of one row for each key and range that are sent to all tasks; beyond it the join shuffles.
FEW = 500_000


def upto(values: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, value, before, upto, total): for each distinct value how many smaller ones its key has, how many up to it, and all.

    The ranges, of key and value, are written once, as they must not change between two uses. What goes over the ranges of a
    key is one number for each of them. A key of null is a key.
    """
    spark = values.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = values.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    path = scratch.new_path(spark, "ranks")
    counted.repartitionByRange(parts, *by, "value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(counted.withColumn("part", F.lit(0)).schema).parquet(path)
    sums = ranged.groupBy("part", *by).agg(F.sum("n").alias("part_n"))
    # One row for each range and key in it.
    of_key = Window.partitionBy(*by)
    starts = sums.select("part", *by, (F.sum("part_n").over(of_key.orderBy("part")) - F.col("part_n")).alias("start"), F.sum("part_n").over(of_key).alias("total"))
    starts = starts.withColumnsRenamed({c: f"{c}_of_key" for c in by}).withColumnRenamed("part", "part_of_key")
    on = ranged["part"] == starts["part_of_key"]
    for c in by:
        on = on & ranged[c].eqNullSafe(starts[f"{c}_of_key"])
    within = F.sum("n").over(Window.partitionBy("part", *by).orderBy("value")) + F.col("start")
    few = F.broadcast(starts) if not by or sums.limit(FEW + 1).count() <= FEW else starts
    return ranged.join(few, on).withColumn("upto", within).select(*by, "value", (F.col("upto") - F.col("n")).alias("before"), "upto", "total")


def _at(rank: Column) -> Column:
    return F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), F.col("value")))


def quantiles(values: DataFrame, column: str, shares: dict[str, float], by: tuple[str, ...] = ()) -> DataFrame:
    """The quantile of each named share, linear between the two values nearest to its rank: one row, NULL without values, or one for each key that has any."""
    ranked = upto(values, column, by)
    rank = {name: (F.col("total") - 1) * share for name, share in shares.items()}
    picked = ranked.groupBy(*by).agg(*[_at(f(r)).alias(f"{name}_{side}") for name, r in rank.items() for side, f in (("low", F.floor), ("high", F.ceil))], F.max("total").alias("total"))
    part = {name: rank[name] - F.floor(rank[name]) for name in shares}
    return picked.select(*by, *[(F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * part[name]).alias(name) for name in shares])


def upper_medians(values: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, columns): the middle value of each column, or the higher of the two, all columns in one pass."""
    long = values.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("of_column")) for c in columns])).alias("c"))
    ranked = upto(long.select(*by, "c.column", "c.of_column"), "of_column", (*by, "column"))
    middle = _at(F.floor(F.col("total") / 2)).alias("middle")
    found = ranked.groupBy(*by, "column").agg(middle)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("middle"))).alias(c) for c in columns])
