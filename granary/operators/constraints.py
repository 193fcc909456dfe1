"""Declarative integrity constraints: each gives violating rows (constraint, key), all are reported together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _violations(rows: DataFrame, name: str, key: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("constraint"), key.cast("string").alias("key"))


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    return _violations(df.groupBy(key).count().filter("count > 1"), name, F.col(key))


def references(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child keys without a parent."""
    keys = child.select(F.col(child_key).alias("_k")).filter("_k IS NOT NULL").distinct()
    return _violations(keys.join(parent.select(F.col(parent_key).alias("_p")), F.col("_k") == F.col("_p"), "left_anti"), name, F.col("_k"))


def disjoint(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    return _violations(a.select(key).intersect(b.select(key)), name, F.col(key))


def check(df: DataFrame, condition: Column, key: str, name: str) -> DataFrame:
    """Rows for which the condition isn't true; unknown counts as a violation."""
    return _violations(df.filter(~F.coalesce(condition, F.lit(False))), name, F.col(key))


def exactly_one(df: DataFrame, columns: list[str], key: str, name: str) -> DataFrame:
    """Rows in which not exactly one of the columns is set: a claim or a reason, never both or neither."""
    return check(df, sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0)) == 1, key, name)


def cardinality(child: DataFrame, key: str, low: int, high: int | None, name: str) -> DataFrame:
    n = F.col("count")
    return _violations(child.groupBy(key).count().filter((n < low) | (n > high if high else F.lit(False))), name, F.col(key))


def unknown_keys(json: Column, known: list[str]) -> Column:
    """Top-level keys of a JSON object that a closed schema doesn't know."""
    return F.array_except(F.json_object_keys(json), F.array(*[F.lit(k) for k in known]))


def facts(df: DataFrame, *marks: tuple) -> DataFrame:
    """space, side, key: what a table has to say about all constraints it takes part in, in one scan.

    marks: (space, "left" or "right", key column) each, and a condition that a row must meet, if any. Null keys say nothing.
    """
    said = []
    for space, side, key, *condition in marks:
        row = F.struct(F.lit(space).alias("space"), F.lit(side).alias("side"), key.cast("string").alias("key"))
        said.append(F.when(key.isNotNull() & (condition[0] if condition else F.lit(True)), row))
    return df.select(F.explode(F.array_compact(F.array(*said))).alias("f")).select("f.*")


def broken(said: list[DataFrame], rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """constraint and key of every broken rule, by one count over all facts that is combined before its shuffle.

    rules: by constraint its space and what breaks it, of n_left and n_right, how often a key stands on either side.
    """
    side = lambda x: F.count_if(F.col("side") == x).alias(f"n_{x}")
    counts = reduce(DataFrame.unionByName, said).groupBy("space", "key").agg(side("left"), side("right"))
    names = [F.when((F.col("space") == space) & fault, F.lit(name)) for name, (space, fault) in rules.items()]
    return counts.select(F.explode(F.array_compact(F.array(*names))).alias("constraint"), "key")


def alone(side: str) -> Column:
    """A key that stands on this side only."""
    other = "right" if side == "left" else "left"
    return (F.col(f"n_{side}") > 0) & (F.col(f"n_{other}") == 0)


def on_both() -> Column:
    return (F.col("n_left") > 0) & (F.col("n_right") > 0)


def repeated(side: str = "left") -> Column:
    return F.col(f"n_{side}") > 1


def checks(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """check for several conditions on one table's rows, in one scan."""
    names = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]
    return df.select(F.explode(F.array_compact(F.array(*names))).alias("constraint"), F.col(key).cast("string").alias("key"))


def all_of(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


def belongs(child: DataFrame, own: str, parent: str, key: str, name: str) -> DataFrame:
    """Child rows that name another parent than the one they are filed under."""
    return check(child, F.col(own) == F.col(parent), key, name)


def recomputed(parent: DataFrame, key: str, child: DataFrame, child_key: str, signals: dict[str, Column], name: str) -> DataFrame:
    """Parents whose stored signals differ from what their children give; a parent without children has none, so 0."""
    found = child.groupBy(F.col(child_key).alias("_k")).agg(*[c.alias(f"_{k}") for k, c in signals.items()])
    met = parent.join(found, F.col(key) == F.col("_k"), "left")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.coalesce(f"_{k}", F.lit(0))) for k in signals])
    return check(met, same, key, name)


def version_is(header: DataFrame, column: str, expected: int, name: str) -> DataFrame:
    """The rows whose version isn't exactly the expected one; older ones are not upgraded."""
    return check(header, F.col(column) == expected, column, name)
