"""Policy tables, ledgers and reports as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import guards
from granary.session import cut
from granary.sources import files

#: Rows that a policy may exclude in one state.
CAP = 15


def read_policy(spark: SparkSession, path: str, schema: str, group: str | None = None, cap: int = CAP) -> DataFrame:
    """A committed JSON list; too many entries for a group are an error."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if group and not rows.groupBy(group).count().filter(F.col("count") > cap).isEmpty():
        raise ValueError(f"{path} has more than {cap} entries for one {group}")
    return rows


def lookup(df: DataFrame, dimension: DataFrame, code: Column, dimension_code: str, value: str) -> DataFrame:
    """df with a dimension's value by case-insensitive code; an unknown code is an error when the rows are read."""
    known = dimension.select(F.upper(dimension_code).alias("_code"), F.col(value).alias(value))
    out = df.join(known, F.upper(code) == F.col("_code"), "left").drop("_code")
    return out.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit("unknown code "), code))).otherwise(F.col(value)))


def write_ledger(dropped: DataFrame, path: str, name: str) -> None:
    """A drop ledger as CSV with a header, sorted by name; ledgers of a run are small next to its input."""
    dropped.orderBy(name).coalesce(1).write.option("header", True).mode("overwrite").csv(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def drop_reasons(ledger: DataFrame) -> DataFrame:
    """reason of every row of a ledger that was read again; a row without one, or a ledger without the column, is unrecorded."""
    reason = F.col("reason") if "reason" in ledger.columns else F.lit(None).cast("string")
    return ledger.select(F.coalesce(F.nullif(F.trim(reason), F.lit("")), F.lit("unrecorded")).alias("reason"))


def read_report(rows: DataFrame, json: str, *keep: str) -> DataFrame:
    """keep, agreement, no_source, by_tier, conflicts, single_source, excluded and demoted of promotion reports that were read again as text.

    What is malformed is left out and the rest stays: entries of a list that lack a name or have one of another kind, tiers without a
    whole number. Counts that can't be read are 0, text that is no object is an empty report.
    """
    entry = lambda *names: T.ArrayType(T.StructType([T.StructField(x, T.StringType()) for x in names]))
    texts, whole = T.ArrayType(T.StringType()), T.LongType()
    kinds = {
        "agreement": whole, "no_source": whole, "by_tier": T.MapType(T.StringType(), whole), "conflicts": entry("name", "first", "second"),
        "single_source": entry("name", "source", "value"), "excluded": texts, "demoted": texts,
    }
    found = rows.select(*keep, guards.read(F.try_parse_json(json), T.StructType([T.StructField(k, v) for k, v in kinds.items()])).alias("_report"))

    def readable(k: str, kind: T.DataType) -> Column:
        part = F.col("_report")[k]
        if kind == whole:
            return F.coalesce(part, F.lit(0)).alias(k)
        if isinstance(kind, T.MapType):
            return F.coalesce(F.map_filter(part, lambda k, v: v.isNotNull()), F.create_map().cast("map<string,bigint>")).alias(k)
        names = kind.elementType.names if isinstance(kind.elementType, T.StructType) else []
        whole_ones = F.filter(part, lambda x: F.concat(*[x[n] for n in names]).isNotNull()) if names else F.array_compact(part)
        return F.coalesce(whole_ones, F.array().cast(kind)).alias(k)

    return found.select(*keep, *[readable(k, kind) for k, kind in kinds.items()])


def report_lines(report: DataFrame) -> list[str]:
    """A report as text: names sorted, one line for each conflict and lone source."""
    row = report.first()
    if row is None:
        return []
    out = [f"sources: {row.agreement} agree, {len(row.conflicts)} conflict, {len(row.single_source)} alone, {row.no_source} none", *[f"tier {k}: {v}" for k, v in sorted(row.by_tier.items())]]
    out += [f"  {x.name}: {x.first} against {x.second}" for x in sorted(row.conflicts)] + [f"  {x.name}: {x.value} ({x.source} alone)" for x in sorted(row.single_source)]
    return [*out, *[f"excluded: {x}" for x in sorted(row.excluded)], *[f"asked by genus: {x}" for x in sorted(row.demoted)]]


def write_nonempty(df: DataFrame, path: str) -> None:
    """Writes nested JSON in one move; an empty table is refused, as it would say that something was tried and failed."""
    if df.isEmpty():
        raise ValueError("refusing to write an empty table")
    files.commit(df, path)


def directory_size(spark: SparkSession, path: str) -> DataFrame:
    """Number and bytes of the files below a path, from metadata alone; both 0 if there is no such path."""
    if not files.exists(spark, path):
        return spark.range(1).select(F.lit(0).cast("long").alias("files"), F.lit(0).cast("long").alias("bytes"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    return found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


class MissingTable(FileNotFoundError):
    """A stage's input isn't there; the stage before has to run first."""


class StaleTable(ValueError):
    """A stage's input was written under another schema; the stage that wrote it has to run again."""


#: Places of a stale table that its error names.
NAMED = 5


def read_nested(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage's nested JSON. Its fields must be those of the schema, at every depth: an unknown one or one of another kind means another build wrote it, and is named."""
    if not files.exists(spark, path):
        raise MissingTable(path)
    want = T._parse_datatype_string(schema)
    bad = unreadable_places(spark.read.text(path), "value", want).limit(NAMED).collect()
    if bad:
        raise StaleTable(f"{path}: {', '.join(sorted({r.fault for r in bad}))}")
    return spark.read.schema(want).option("mode", "FAILFAST").json(path)


def unreadable_places(rows: DataFrame, json: str, closed: T.DataType, *keep: str) -> DataFrame:
    """keep and fault: a row for every place of the JSON texts that a closed schema doesn't allow, and for texts that are no JSON."""
    parsed = F.try_parse_json(json)
    found = F.when(parsed.isNull(), F.array(F.lit("no JSON"))).otherwise(guards.faults(parsed, closed))
    return rows.select(*keep, F.explode(found).alias("fault"))


def refreshed_places(states: DataFrame, found: DataFrame, path: str) -> None:
    """Writes code, name and place_id of every state (code, name), or nothing at all if one has no place.

    found: name, results; the projected hits of a search for each name.
    """
    from granary.operators.nested import state_place

    rows = states.join(found.withColumnRenamed("name", "_asked"), F.col("name") == F.col("_asked"), "left")
    rows = cut(rows.select("code", "name", state_place(F.col("results"), F.col("name")).alias("place_id")))
    lost = rows.filter("place_id IS NULL").agg(F.array_sort(F.collect_list("code")).alias("codes")).first().codes
    if lost:
        raise LookupError(f"no place for {', '.join(lost)}")
    files.commit(rows, path)
