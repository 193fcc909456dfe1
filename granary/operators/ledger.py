"""Kept rows and a ledger of dropped ones: nothing disappears without a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that holds; null if none does."""
    out = F.when(*rules[0])
    for condition, reason in rules[1:]:
        out = out.when(condition, reason)
    return out


def split(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) by whether the reason column is null."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def vocabulary(spark: SparkSession, words: tuple[str, ...], column: str = "reason") -> DataFrame:
    """A closed vocabulary as rows."""
    return spark.createDataFrame([(w,) for w in words], f"{column} string")


def zero_filled(rows: DataFrame, words: tuple[str, ...], column: str = "reason", count: str = "n") -> DataFrame:
    """Row counts for every word of a vocabulary, 0 where none occurs; the vocabulary is the small side."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    return vocabulary(rows.sparkSession, words, column).join(counts, column, "left").select(column, F.coalesce(count, F.lit(0)).alias(count))


def union_ledgers(*ledgers: DataFrame) -> DataFrame:
    out = ledgers[0]
    for x in ledgers[1:]:
        out = out.unionByName(x)
    return out


def partition_faults(whole: DataFrame, kept: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Keys that are in neither part, in both, or in a part alone; empty if kept and dropped partition the whole."""
    parts = kept.select(key).union(dropped.select(key))
    marks = whole.select(key, F.lit(1).alias("w"), F.lit(0).alias("p")).union(parts.select(key, F.lit(0), F.lit(1)))
    return marks.groupBy(key).agg(F.sum("w").alias("in_whole"), F.sum("p").alias("in_parts")).filter("in_whole <> in_parts")
