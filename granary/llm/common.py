"""What several of the operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from contextlib import contextmanager
from functools import cache, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words, as a Java character class and as bytes.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named in spark.checkpoint.dir; only in local mode may it be unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    path = tempfile.mkdtemp("granary")
    atexit.register(shutil.rmtree, path, True)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in any store that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared folder, without their lineage; the files go once nothing refers to the rows any more."""
    context = df.sparkSession.sparkContext
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def cut_few(df: DataFrame) -> DataFrame:
    """cut, for tables with few and small rows next to the texts (links, totals, ids): an eighth of the shuffle's partitions, so fewer files."""
    return cut(df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)))


#: Bytes of a batch that goes between Spark and Python where whole texts pass.
BATCH_BYTES = 8 * 1024 * 1024


@contextmanager
def small_batches(spark: SparkSession):
    """Inside, what is run at once sends rows to Python in batches of BATCH_BYTES: buffers double as they grow, on both sides and for each task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut_texts(df: DataFrame) -> DataFrame:
    """cut, for rows that Python makes of whole texts."""
    with small_batches(df.sparkSession):
        return cut(df)


#: Bytes of a table's files up to which its rows are dealt out before Python reads their texts.
SPREAD_BYTES = 32_000_000


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out to all cores if they come from so few bytes that one file, or a part of one, may hold them all; others stay where they are read."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else df


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than SPACES; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("long")


def without_spaces(text: Column) -> Column:
    """The text with every character of SPACES deleted; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def join_known(left: DataFrame, right: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Joins on equal columns, nulls included; no other column may be in both. Keeps the left side's columns once."""
    other = right.select(*[F.col(c).alias(f"_right_{c}" if c in columns else c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns]
    return left.join(other, reduce(Column.__and__, same), how).drop(*[f"_right_{c}" for c in columns])


#: Rows of a table of ids or hashes up to which it is broadcast, and bytes; larger ones meet their partners in a shuffle.
MOST_SENT, MOST_SENT_BYTES = 250_000, 32_000_000


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    sizes = [F.lit(8 * len(df.columns))]
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)))
        elif kind.startswith("array"):
            sizes.append(8 * F.greatest(F.size(f"`{name}`"), F.lit(0)))
    return reduce(Column.__add__, [c.cast("long") for c in sizes])


def sent(table: DataFrame) -> DataFrame:
    """A table of few values a row, cut from its lineage, marked for broadcast if its rows and their bytes are few enough."""
    table = cut_few(table)
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(table)), F.lit(0))).first()
    return F.broadcast(table) if rows <= MOST_SENT and size <= MOST_SENT_BYTES else table


def text_key(text: Column) -> Column:
    """Together with an id, what tells rows apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_rows(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are kept, with their columns; of kept rows that repeat an id together with its text, one.

    judged: doc_id, own (text_key of the text) and kept, for every row. Rows to drop, and rows to choose
    from, are looked up, so that texts aren't shuffled as long as these are few enough to be sent.
    """
    known = judged.groupBy("doc_id", "own").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).filter("NOT stays OR n > 1")
    known = cut(known.select(F.col("doc_id").alias("of_id"), "own", "stays"))
    same = lambda table: docs[id_col].cast("long").eqNullSafe(table["of_id"]) & (text_key(docs[text_col]) == table["own"])
    gone, several = sent(known), known.filter("stays")
    once = docs.join(gone, same(gone), "left_anti")
    if several.isEmpty():
        return once
    several = sent(several)
    rows = docs.join(several, same(several), "left_semi")
    whole = F.struct(*[rows[c] for c in docs.columns])
    try:
        one = rows.groupBy(rows[id_col], text_key(rows[text_col])).agg(F.min(whole).alias("row"))
        one.schema  # noqa: B018  (some kinds of columns have no order)
    except AnalysisException:
        one = rows.groupBy(rows[id_col], text_key(rows[text_col])).agg(F.first(whole).alias("row"))
    return once.union(one.select("row.*"))
