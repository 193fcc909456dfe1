"""Content-addressed storage: dedup, incremental reuse and garbage collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import cut
from granary.sources import files


def addressed(df: DataFrame, content: str) -> DataFrame:
    """df with sha256 and shard, the digest's first two hex digits."""
    return df.withColumn("sha256", F.sha2(F.col(content), 256)).withColumn("shard", F.substring("sha256", 1, 2))


def new_contents(df: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per digest that the store hasn't got."""
    return df.dropDuplicates(["sha256"]).join(stored.select("sha256"), "sha256", "left_anti")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The store's contents, one row per digest; None if there is no store yet."""
    known = _entries(spark, path)
    return None if known is None else known.dropDuplicates(["sha256"])


def _entries(spark: SparkSession, path: str, shards: list[str] | None = None) -> DataFrame | None:
    """What lies in the store, in the directories of some shards only if they are named; None if there is no store yet."""
    if not files.exists(spark, path) or not files.has_entries(spark, path):
        return None
    found = spark.read.parquet(path).schema
    # a shard stays text, also where all of them look like numbers
    known = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name == "shard" else f for f in found.fields])).parquet(path)
    return known if shards is None else known.filter(F.col("shard").isin(*shards))


#: Directories of a store: two hexadecimal digits.
SHARDS = 256


def _shards_of(rows: DataFrame) -> list[str]:
    """The shards of some rows, SHARDS at most."""
    return sorted(r.shard for r in rows.select("shard").distinct().limit(SHARDS).collect())


def write_contents(df: DataFrame, path: str) -> DataFrame:
    """Appends the contents that the store hasn't got, a directory per shard, and returns them.

    Of the store only digests are read, and only in the directories of the shards that come in; only contents that are
    new are shuffled. One writer at a time looks and writes, under the store's lock.
    """
    spark = df.sparkSession
    with files.lock(spark, path):
        incoming = cut(df.select("sha256", "shard").distinct())
        known = _entries(spark, path, _shards_of(incoming))
        new = incoming if known is None else cut(incoming.join(known.select("sha256"), "sha256", "left_anti"))
        fresh = cut(df.join(new.select("sha256"), "sha256", "left_semi").dropDuplicates(["sha256"]))
        fresh.write.mode("append").partitionBy("shard").parquet(path)
    return fresh


def collect(spark: SparkSession, path: str, referenced: DataFrame, dry_run: bool = True) -> DataFrame:
    """Digest and shard of the contents that nothing refers to; unless it is a dry run, they are deleted.

    What is garbage follows from digests alone. Contents are read of the shards that hold any, whose directories are written again
    and put in place by the commit of one job.
    """
    known = _entries(spark, path)
    if known is None:
        return spark.createDataFrame([], "sha256 string, shard string")
    with files.lock(spark, path):
        gone = cut(known.select("sha256", "shard").distinct().join(referenced.select("sha256"), "sha256", "left_anti"))
        shards = [] if dry_run else _shards_of(gone)
        if shards:
            left = cut(_entries(spark, path, shards).dropDuplicates(["sha256"]).join(gone.select("sha256"), "sha256", "left_anti"))
            left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
            for shard in {*shards} - {*_shards_of(left)}:
                files.delete(spark, f"{path}/shard={shard}")
    return gone


def garbage(stored: DataFrame, referenced: DataFrame, key: str = "sha256") -> DataFrame:
    """Stored digests that nothing refers to."""
    return stored.select(key).distinct().join(referenced.select(key), key, "left_anti")


def reusable(wanted: DataFrame, settled: DataFrame, group: str, item: str) -> DataFrame:
    """group, n_wanted, reuse: a group is reused if every wanted item was stored or has failed before.

    Missing items are found by one outer join and counted, so no group's items are collected.
    """
    known = settled.select(group, item).distinct().withColumn("_known", F.lit(1))
    marked = wanted.select(group, item).distinct().join(known, [group, item], "left")
    return marked.groupBy(group).agg(F.count(F.lit(1)).alias("n_wanted"), (F.count("_known") == F.count(F.lit(1))).alias("reuse"))


def latest(rows: DataFrame, key: str, priority: str) -> DataFrame:
    """Of rows that several sources give for a key the one of the highest priority."""
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(priority)))
    return rows.withColumn("_n", best).filter("_n = 1").drop("_n")
