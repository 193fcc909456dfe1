"""Claims carry a value, its sources and a confidence; fusing two sources is the only way to join claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import cut

CONFIDENCE = ("medium", "high")
OUTCOMES = ("agreement", "conflict", "single_source", "no_source")
TIER_CONFIDENCE = {1: "high", 2: "high", 3: "medium"}


def weakest(*confidences: Column) -> Column:
    """The lowest of ordered confidences."""
    rank = lambda c: F.array_position(F.array(*[F.lit(x) for x in CONFIDENCE]), c)
    return F.element_at(F.array(*[F.lit(x) for x in CONFIDENCE]), F.least(*[rank(c) for c in confidences]).cast("int"))


def fuse(first: str, second: str, second_confidence: str = "high") -> dict[str, Column]:
    """outcome, value, confidence, sources and reason from two claim structs (value, confidence, sources), each maybe null.

    Agreement keeps the value, lists the first source's references first and is no surer than the weaker
    claim. A conflict makes no claim. One source alone is of medium confidence.
    """
    a, b = F.col(first), F.col(second)
    has_a, has_b = a["value"].isNotNull(), b["value"].isNotNull()
    both = has_a & has_b
    outcome = F.when(both & (a["value"] == b["value"]), "agreement").when(both, "conflict").when(has_a | has_b, "single_source").otherwise("no_source")
    agreed = outcome == "agreement"
    return {
        "outcome": outcome,
        "value": F.when(agreed, a["value"]).when(outcome == "single_source", F.coalesce(a["value"], b["value"])),
        "confidence": F.when(agreed, weakest(a["confidence"], F.lit(second_confidence))).when(outcome == "single_source", "medium"),
        "sources": F.when(agreed, F.concat(a["sources"], b["sources"])).when(outcome == "single_source", F.when(has_a, a["sources"]).otherwise(b["sources"])),
        "reason": F.when(outcome == "conflict", "source_conflict").when(outcome == "no_source", "no_nativity_source"),
    }


def best_tier(matches: DataFrame, key: str, tier: str = "tier") -> DataFrame:
    """Of every key's matches those of its lowest tier."""
    return matches.withColumn("_best", F.min(tier).over(Window.partitionBy(key))).filter(F.col(tier) == F.col("_best")).drop("_best")


def best_groups(asked: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """key, tier, group, alone: of the groups that every key asks for those of its lowest tier, if anything is offered in them.

    asked: key, tier, group. offered: tier, group, any number of rows. Groups are looked up and not their rows, so this grows with
    the keys and not with the pairs. alone says that the key has no other group: what holds of the group holds of the key.
    """
    known = offered.select("tier", "group").distinct()
    best = best_tier(asked.select(key, "tier", "group").distinct().join(known, ["tier", "group"], "left_semi"), key)
    return cut(best.withColumn("alone", F.count(F.lit(1)).over(Window.partitionBy(key)) == 1))


#: About how many keys of a group meet its offers in one part.
PART = 1000


def expanded(groups: DataFrame, offered: DataFrame, key: str, *columns: str) -> DataFrame:
    """key, tier and columns, each combination once: what the groups of best_groups offer to every key.

    There may be many more pairs than keys. A group goes to the tasks in parts of its keys, each with all that is offered, and only
    keys with several groups are looked through for repetitions.
    """
    spark = groups.sparkSession
    parts = groups.groupBy("tier", "group").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("_parts"))
    tasks, by = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), ["tier", "group", "_part"]
    left = groups.join(parts, ["tier", "group"]).withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).drop("_parts")
    right = offered.select("tier", "group", *columns).distinct().join(parts, ["tier", "group"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    # a number of tasks of its own: by the size of what is shuffled, Spark would give all pairs to a few
    met = lambda rows: rows.repartition(tasks, *by).join(right.repartition(tasks, *by), by).select(key, "tier", *columns)
    return met(left.filter("alone")).unionByName(met(left.filter("NOT alone")).distinct())


def group_consensus(groups: DataFrame, offered: DataFrame, key: str, target: str, value: str) -> DataFrame:
    """consensus of what the groups of best_groups offer to every key, found once a group."""
    found = consensus(offered.withColumn("_of", F.struct("tier", "group")), "_of", target, value)
    agreed = groups.filter("alone").join(found, F.struct("tier", "group") == F.col("_of")).select(key, *found.drop("_of").columns)
    return agreed.unionByName(consensus(expanded(groups.filter("NOT alone"), offered, key, target, value), key, target, value))


def consensus(matches: DataFrame, key: str, target: str, value: str) -> DataFrame:
    """key, symbol, value, n_targets, reason: accepted if all distinct targets agree, a missing value being a value of its own."""
    distinct = matches.select(key, target, value).distinct()
    grouped = distinct.groupBy(key).agg(
        F.min(target).alias("symbol"), F.count(F.lit(1)).alias("n_targets"), F.max(value).alias("_value"),
        F.count_distinct(value).alias("_values"), F.max(F.col(value).isNull().cast("int")).alias("_null"),
    )
    agreed = F.col("_values") + F.col("_null") == 1
    return grouped.select(
        key, "symbol", F.when(agreed, F.col("_value")).alias("value"), "n_targets",
        F.when(~agreed, "ambiguous_match").when(F.col("_value").isNull(), "no_status").alias("reason"),
    )


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows that repeat a key the last in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).filter("_n = 1").drop("_n")


def scoped(value: Column, answered: Column, asked: Column) -> Column:
    """struct<value, reason>: the value only if it was answered for the place asked; a null place is no place."""
    return F.struct(F.when(answered.eqNullSafe(asked), value).alias("value"), F.when(~answered.eqNullSafe(asked), "place_not_state_scoped").alias("reason"))


def fusion_summary(decisions: DataFrame) -> DataFrame:
    """One line: how often the sources agreed, conflicted, spoke alone or not at all."""
    of = lambda x: F.count_if(F.col("outcome") == x).alias(x)
    line = F.format_string("%d agreed, %d conflicted, %d single-source, %d unsourced", *OUTCOMES)
    return decisions.agg(*map(of, OUTCOMES)).select(line.alias("line"))
