"""Promotion: exclusions, claims and demotions decide which rows enter the final table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude(df: DataFrame, exclusions: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded); exclusions is a policy table whose size is capped per key group, Spark broadcasts it if small."""
    return df.join(exclusions.select(keys), keys, "left_anti"), df.join(exclusions, keys, "inner")


def answer_rank(df: DataFrame, demotions: DataFrame, key: str) -> DataFrame:
    """df with answer_rank: genus where the key is on the list, else species."""
    listed = demotions.select(F.col(key).alias("_key")).distinct().withColumn("_listed", F.lit(True))
    out = df.join(listed, df[key] == F.col("_key"), "left")
    return out.withColumn("answer_rank", F.when(F.col("_listed"), "genus").otherwise("species")).drop("_key", "_listed")


def promote(df: DataFrame, key: str, exclusions: DataFrame, claims: DataFrame, reasons: DataFrame) -> DataFrame:
    """df with decision and reason. An exclusion goes before the claim; without a claim the reason is looked up, no_claim if there is none."""
    out = df.join(exclusions.select(F.col(key).alias("_x")).distinct(), F.col(key) == F.col("_x"), "left")
    out = out.join(claims.select(F.col(key).alias("_c"), "value"), F.col(key) == F.col("_c"), "left")
    out = out.join(reasons.select(F.col(key).alias("_r"), F.col("reason").alias("_why")), F.col(key) == F.col("_r"), "left")
    reason = F.when(F.col("_x").isNotNull(), "excluded").when(F.col("_c").isNull(), F.coalesce("_why", F.lit("no_claim")))
    return out.withColumn("reason", reason).withColumn("decision", F.when(reason.isNull(), "promoted").otherwise("unmatched")).drop("_x", "_c", "_r", "_why")


def for_state(exclusions: DataFrame, state: str) -> DataFrame:
    """The entries (state, id, name, reason, source) of a state, whatever its case."""
    return exclusions.filter(F.upper("state") == state.upper()).drop("state")


def exclusion_detail(current: Column) -> Column:
    """The reasoning of a joined exclusion (_name, _reason, _source); an entry written under another name says so."""
    detail = F.format_string("%s [%s]", "_reason", "_source")
    moved = F.format_string("%s (made for '%s', now '%s': look again)", detail, F.col("_name"), current)
    return F.when(F.col("_name").eqNullSafe(current), detail).otherwise(moved)


def unmatched_details(df: DataFrame, key: str, name: str, exclusions: DataFrame, reasons: DataFrame) -> DataFrame:
    """reason and detail of every row that has no claim; exclusions go before what the claim's making says.

    exclusions: key, name, reason, source. reasons: key, reason, detail.
    """
    out = df.join(exclusions.select(F.col(key).alias("_x"), F.col("name").alias("_name"), F.col("reason").alias("_reason"), F.col("source").alias("_source")), F.col(key) == F.col("_x"), "left")
    out = out.join(reasons.select(F.col(key).alias("_r"), F.col("reason").alias("_why"), F.col("detail").alias("_detail")), F.col(key) == F.col("_r"), "left")
    excluded = F.col("_x").isNotNull()
    reason = F.when(excluded, "curated_exclusion").otherwise(F.coalesce("_why", F.lit("no_claim")))
    detail = F.when(excluded, exclusion_detail(F.col(name))).otherwise(F.coalesce("_detail", F.lit("no value was determined")))
    return out.select(*df.columns, reason.alias("reason"), detail.alias("detail"))


def counters(decided: DataFrame) -> DataFrame:
    """One row: promoted, unmatched, excluded and demoted rows, and promoted ones by value. decided: decision, reason, value, answer_rank."""
    promoted = F.col("decision") == "promoted"
    by_value = decided.filter("decision = 'promoted'").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    sums = decided.agg(
        F.count_if(promoted).alias("promoted"), F.count_if(~promoted).alias("unmatched"), F.count_if(~promoted & F.col("reason").isin("excluded", "curated_exclusion")).alias("excluded"),
        F.count_if(promoted & (F.col("answer_rank") == "genus")).alias("demoted"),
    )
    values = by_value.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("by_value"))
    return sums.join(values)


def summary(counts: DataFrame) -> DataFrame:
    line = F.format_string("%d promoted, %d unmatched, %d genus-demoted, %d excluded", "promoted", "unmatched", "demoted", "excluded")
    return counts.select(line.alias("line"))


def report(decided: DataFrame, matched: DataFrame, fused: DataFrame, names: DataFrame) -> DataFrame:
    """One row with the ten keys of the promotion's audit; names and lists are sorted.

    decided: id, name, decision, reason, value, answer_rank. matched: id, tier, of everything that was
    reconciled, excluded or not. fused: id, outcome, first, second (the two sources' values). names: id, name.
    """
    named = fused.join(names.select("id", "name"), "id")
    sorted_names = lambda rows: F.array_sort(F.collect_list(rows))
    conflict, single = F.col("outcome") == "conflict", F.col("outcome") == "single_source"
    tiers = matched.filter("tier IS NOT NULL").groupBy("tier").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        counters(decided).select("promoted", "unmatched", "by_value"),
        decided.agg(sorted_names(F.when((F.col("decision") == "promoted") & (F.col("answer_rank") == "genus"), F.col("name"))).alias("demoted"), sorted_names(F.when(F.col("reason").isin("excluded", "curated_exclusion"), F.col("name"))).alias("excluded")),
        tiers.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("tier").cast("string").alias("tier"), "n")))).alias("by_tier")),
        named.agg(
            F.count_if(F.col("outcome") == "agreement").alias("agreement"), F.count_if(F.col("outcome") == "no_source").alias("no_source"),
            sorted_names(F.when(conflict, F.struct("name", "first", "second"))).alias("conflicts"),
            sorted_names(F.when(single, F.struct("name", F.when(F.col("first").isNotNull(), "first").otherwise("second").alias("source"), F.coalesce("first", "second").alias("value")))).alias("single_source"),
        ),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.join(x)  # one row each
    return out.select("agreement", "by_tier", "by_value", "conflicts", "demoted", "excluded", "no_source", "promoted", "single_source", "unmatched")
