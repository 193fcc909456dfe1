"""Stratified, capped round-robin sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = ("A", "B", "C", "D")
OWNER_CAP, MOST = 2, 8


def month_bucket(date: Column) -> Column:
    """A: March to May, B: June and July, C: August and September, D: October to February."""
    m = F.month(date)
    return F.when(m.between(3, 5), "A").when(m.between(6, 7), "B").when(m.between(8, 9), "C").otherwise("D")


def round_robin(df: DataFrame, group: str, bucket: str, item: str, most: int = MOST) -> DataFrame:
    """Items in the order in which turns over the buckets take them, without a cap: plain window ranks."""
    turn = F.row_number().over(Window.partitionBy(group, bucket).orderBy(item))
    place = F.row_number().over(Window.partitionBy(group).orderBy("turn", bucket))
    near = df.withColumn("turn", turn).filter(F.col("turn") <= most)
    return near.withColumn("place", place).filter(F.col("place") <= most).drop("turn")


def head_per_owner(df: DataFrame, group: str, bucket: str, owner: str, item: str, cap: int = OWNER_CAP) -> DataFrame:
    """Only an owner's first `cap` items of a bucket can ever be taken; this bounds what a group collects."""
    rank = F.row_number().over(Window.partitionBy(group, bucket, owner).orderBy(item))
    return df.withColumn("_n", rank).filter(F.col("_n") <= cap).drop("_n")


def round_robin_capped(df: DataFrame, group: str, bucket: str, owner: str, item: str, cap: int = OWNER_CAP, most: int = MOST) -> DataFrame:
    """group and chosen: the items that turns over the buckets take, at most `most`, no more than `cap` of one owner.

    The cap spans the buckets, so a step depends on all steps before it: a fold over the turns, in built-in
    functions. A turn that takes nothing from a bucket never will again, so `most` rounds suffice. Each
    bucket needs at most `most` owners' first items, so what is collected for a group is bounded.
    """
    near = head_per_owner(df, group, bucket, owner, item, cap)
    near = near.withColumn("_place", F.row_number().over(Window.partitionBy(group, bucket).orderBy(item)))
    near = near.filter(F.col("_place") <= most * cap * len(BUCKETS))
    entry = F.struct(F.col(item).alias("i"), F.col(bucket).alias("b"), F.col(owner).alias("o"))
    grouped = near.groupBy(group).agg(F.array_sort(F.collect_list(entry)).alias("items"))

    def step(taken, k):
        name = F.element_at(F.array(*[F.lit(b) for b in BUCKETS]), (F.pmod(k, F.lit(len(BUCKETS))) + 1).cast("int"))
        free = F.filter("items", lambda x: (x["b"] == name) & ~F.exists(taken, lambda t: t["i"] == x["i"]) & (F.size(F.filter(taken, lambda t: t["o"] == x["o"])) < cap))
        return F.when(F.size(taken) >= most, taken).otherwise(F.concat(taken, F.slice(free, 1, 1)))

    none = F.slice("items", 1, 0)
    return grouped.select(group, F.aggregate(F.sequence(F.lit(0), F.lit(most * len(BUCKETS) - 1)), none, step).alias("chosen"))
