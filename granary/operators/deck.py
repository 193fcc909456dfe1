"""Ranked, prefix-limited selection with a ledger of what was rejected before the limit was reached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import cut


def first_occurrence(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _counted(df: DataFrame, order: str, kept: Column) -> tuple[DataFrame, int]:
    """(df with kept_before, number of kept rows). Rows are dealt into ranges of the order, as even as Spark's sample makes them."""
    ranged = cut(df.withColumn("_kept", kept.cast("int")).repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    ahead, offsets = 0, []
    for row in ranged.groupBy("_range").agg(F.sum("_kept").alias("n")).orderBy("_range").collect():  # a line for each partition
        offsets.append((row["_range"], ahead))
        ahead += row["n"]
    offsets = df.sparkSession.createDataFrame(offsets, "_range int, _ahead long")
    within = F.coalesce(F.sum("_kept").over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = ranged.withColumn("_within", within).join(F.broadcast(offsets), "_range")
    return counted.withColumn("kept_before", F.col("_ahead") + F.col("_within")).drop("_range", "_kept", "_within", "_ahead"), ahead


def running_kept(df: DataFrame, order: str, kept: Column) -> DataFrame:
    """df with kept_before, the number of kept rows ahead in the order, without bringing all rows into one task.

    Counts of whole ranges of the order are added up over the few ranges, and within a range a window counts on. The order must be unique.
    """
    return _counted(df, order, kept)[0]


#: Size of the sketch that finds where a prefix may end, and the share of the kept rows by which its ranks may be off.
SKETCH, OFF = 4000, 0.004


def _leading(df: DataFrame, order: str) -> Column:
    """The order as a number, or the first field of an order of several numbers."""
    kind = df.schema[order].dataType
    return F.col(order)[kind[0].name].cast("long") if isinstance(kind, T.StructType) else F.col(order)


def prefix_bound(df: DataFrame, order: str, kept: Column, limit: int) -> int | None:
    """A value of the order up to which about limit kept rows lie, rather more than fewer; None if the sketch can't leave anything out."""
    sketch = df.filter(kept).select(_leading(df, order).alias("_at")).agg(F.kll_sketch_agg_bigint("_at", F.lit(SKETCH)).alias("k"))
    row = sketch.select("k", F.kll_sketch_get_n_bigint("k").alias("n")).first()
    share = max(limit / row["n"] + OFF, 0.0) if row["n"] else 1.0
    if share >= 1:
        return None
    return df.sparkSession.range(1).select(F.kll_sketch_get_quantile_bigint(F.lit(bytes(row["k"])), F.lit(share)).alias("bound")).first()["bound"]


def ranked_prefix(df: DataFrame, order: str, reason: str, limit: int) -> DataFrame:
    """The rows up to the one that fills the limit of kept rows (null reason): later rows are neither kept nor dropped.

    A mergeable sketch of the kept rows' order, one number a task and entry, says where about the limit is filled; only the
    rows up to there are shuffled and counted. If they hold too few kept ones after all, every row is counted.
    The order is unique: a number, or a struct of numbers.
    """
    kept = F.col(reason).isNull()
    bound = prefix_bound(df, order, kept, limit)
    if bound is not None:
        counted, n = _counted(df.filter(_leading(df, order) <= bound), order, kept)
        if n >= limit:
            return counted.filter(F.col("kept_before") < limit).drop("kept_before")
    return _counted(df, order, kept)[0].filter(F.col("kept_before") < limit).drop("kept_before")


def short_prefix(df: DataFrame, order: str, reason: str, limit: int) -> DataFrame:
    """ranked_prefix of a table that the caller knows to be short, such as one that a limit has cut: one window in one task."""
    ahead = F.count_if(F.col(reason).isNull()).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_ahead", ahead).filter(F.col("_ahead") < limit).drop("_ahead")
