"""Exact statistics: zero-filled histograms, nearest-rank percentiles, truncated medians, shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import cut


def _counted_rank(df: DataFrame, keys: list[str], value: str, fraction: float, name: str) -> DataFrame:
    """nearest_rank by counts of all distinct values."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto).withColumn("_rank", F.bround(F.lit(fraction) * (F.sum("_n").over(group) - 1).cast("double")))
    return ranked.filter(F.col("_upto") > F.col("_rank")).groupBy(*keys).agg(F.min(value).alias(name))


#: Size of a group's sketch, and by how much of the rows a bracket is wider than the sketch's rank on either side.
SKETCH, OFF = 2000, 0.01


#: Groups whose brackets are sent to the rows, by their number and the bytes of their keys; more of them meet the rows in a shuffle.
SENT, SENT_BYTES = 100_000, 32 << 20


def _sent(groups: DataFrame) -> DataFrame:
    """groups, marked for a broadcast if they are few: rows of a few large groups must not be shuffled to as many tasks."""
    keys = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in groups.columns if k.startswith("_of_")]
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(reduce(Column.__add__, keys)), F.lit(0)).alias("bytes")).first()
    return F.broadcast(groups) if size.n <= SENT and size.bytes <= SENT_BYTES else groups


def nearest_rank(df: DataFrame, keys: list[str], value: str, fraction: float, name: str) -> DataFrame:
    """The value at the rank round-half-even(fraction * (n - 1)) of every group; nulls don't count.

    A mergeable sketch of each group brackets the value. Rows below the bracket are counted where they lie and only distinct values inside
    it are shuffled, a few hundredths of them, so a group of nearly as many values as rows is no larger than others. Brackets are sent to
    the rows, unless they are very many. That the value lies in
    its bracket follows from the counts; a group for which it doesn't has all its values counted. Values that aren't numbers are counted likewise.
    """
    rows = df.select(*keys, value).filter(F.col(value).isNotNull())
    if not isinstance(rows.schema[value].dataType, T.NumericType):
        return _counted_rank(rows, keys, value, fraction, name)
    number = F.col(value).cast("double")
    at = lambda q: F.kll_sketch_get_quantile_double("_k", F.lit(min(1.0, max(0.0, q))))
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.kll_sketch_agg_double(number, F.lit(SKETCH)).alias("_k"))
    groups = cut(groups.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_rows", at(fraction - OFF).alias("_low"), at(fraction + OFF).alias("_high")))

    same = reduce(Column.__and__, [rows[k].eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    met = rows.join(_sent(groups), same).filter(number <= F.col("_high"))
    inside = F.when(number >= F.col("_low"), F.col(value))
    counts = met.groupBy(*keys, inside.alias("_value")).agg(F.count(F.lit(1)).alias("_n"), F.any_value("_rows").alias("_rows"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.withColumn("_upto", upto).filter(F.col("_upto") > F.bround(F.lit(fraction) * (F.col("_rows") - 1).cast("double")))
    # the rows below come first; if they alone reach the rank, or nothing does, the bracket missed it
    first = F.min(F.struct(F.col("_value").isNotNull().alias("hit"), F.col("_value").alias("value")))
    found = reached.groupBy(*keys).agg(first.alias("_first"))
    found = cut(found.filter("_first.hit").select(*keys, F.col("_first.value").alias(name)))
    known = found.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    missed = groups.join(known, reduce(Column.__and__, [F.col(f"_of_{k}").eqNullSafe(F.col(f"_known_{k}")) for k in keys]), "left_anti")
    if missed.isEmpty():
        return found
    return found.unionByName(_counted_rank(rows.join(missed, same, "left_semi"), keys, value, fraction, name))


def truncated_median(value: Column) -> Column:
    """The median without its fraction; null for no rows."""
    return F.median(value).cast("long")


def histogram(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def with_share(counts: DataFrame, count: str = "n", share: str = "share_pct") -> DataFrame:
    """Percentages of the total, 0 if there is nothing; counts are few rows."""
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(share, F.when(total == 0, F.lit(0.0)).otherwise(100.0 * F.col(count) / total))


def thin_rich(df: DataFrame, key: str, ceiling: int = 5) -> DataFrame:
    sizes = df.groupBy(key).count()
    return sizes.agg(F.count_if(F.col("count") <= ceiling).alias("thin"), F.count_if(F.col("count") > ceiling).alias("rich"))
