"""Response caches: keys, envelopes and journals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = ("endpoint", "params", "projection_version", "fetched_at", "response")


def cache_key(endpoint: str, params: dict[str, Column], projection_version: int) -> Column:
    """SHA-256 of the request's canonical JSON: keys sorted, no spaces. A list differs from its joined string."""
    ordered = F.struct(*[params[k].alias(k) for k in sorted(params)])
    return F.sha2(F.to_json(F.struct(F.lit(endpoint).alias("endpoint"), ordered.alias("params"), F.lit(projection_version).alias("projection_version"))), 256)


def second_key(endpoint: str, key: Column, projection: int) -> Column:
    """The key of the second source's requests, which have one parameter: SHA-256 of their compact JSON."""
    return F.sha2(F.to_json(F.struct(F.lit(endpoint).alias("endpoint"), key.alias("key"), F.lit(projection).alias("projection"))), 256)


def read_envelopes(spark: SparkSession, path: str, response: T.DataType, projection_version: int | None = None) -> DataFrame:
    """Cached responses, one per file. A file that is no JSON object or lacks an envelope's key is an error."""
    schema = T.StructType([
        T.StructField("endpoint", T.StringType()), T.StructField("params", T.MapType(T.StringType(), T.StringType())), T.StructField("projection_version", T.IntegerType()),
        T.StructField("fetched_at", T.StringType()), T.StructField("response", response),
    ])
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    whole = F.col("endpoint").isNotNull() & F.col("fetched_at").isNotNull() & F.col("response").isNotNull()
    rows = rows.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit("not a cache envelope")).cast("boolean")))
    return rows if projection_version is None else rows.filter(F.col("projection_version") == projection_version)


def append_journal(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def replay_journal(spark: SparkSession, path: str, schema: T.StructType, key: str, order: str) -> DataFrame:
    """The last line of every key; truncated lines are skipped."""
    from granary.operators.claims import last_wins

    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    lines = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return last_wins(lines.filter(F.col("_corrupt").isNull()).drop("_corrupt").filter(F.col(key).isNotNull()), [key], order)
