"""Read-through scans of cached responses. What reaches the network is a callable that the caller gives.

Requests are rows. Those that the cache holds are read, the others are fetched by a function of a DataFrame,
checked, projected and written; then everything is read from the cache, so that a hit and a miss give the same rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import deck, ledger
from granary.sources.cache import ENVELOPE
from granary.sources.files import exists

#: Seconds between two requests, the first wait after a throttled one (doubled each time), and how often it is tried again.
INTERVAL, FIRST_WAIT, RETRIES = 0.7, 30.0, 4
#: Requests that one task has under way.
CONCURRENCY = 8
THROTTLED = 429


class Response(NamedTuple):
    status: int
    content_type: str | None = None
    body: bytes | None = None
    retry_after: str | None = None


class ThrottledError(RuntimeError):
    """The server still refuses after every retry."""


class CacheMissError(LookupError):
    """An offline scan lacks responses."""


def paced(call: Callable, interval: float = INTERVAL, sleep: Callable = time.sleep, clock: Callable = time.monotonic) -> Callable:
    """call, begun no sooner than so many seconds after the one before ended."""
    last: list[float] = []

    def run(request):
        if last and (wait := interval - (clock() - last[0])) > 0:
            sleep(wait)
        try:
            return call(request)
        finally:
            last[:] = [clock()]

    return run


def with_backoff(call: Callable, retries: int = RETRIES, first: float = FIRST_WAIT, sleep: Callable = time.sleep) -> Callable:
    """call, tried again after throttled responses: as long later as the server says, a second at least, or else twice as long each time."""

    def run(request):
        wait = first
        for left in range(retries, -1, -1):
            response = call(request)
            if response.status != THROTTLED:
                return response
            if not left:
                break
            try:
                sleep(max(1.0, float(response.retry_after)))
            except (TypeError, ValueError):
                sleep(wait)
            wait *= 2
        raise ThrottledError(f"still throttled after {retries} retries; what was fetched is cached")

    return run


def fetch_each(make_call: Callable[[], Callable], concurrency: int = CONCURRENCY) -> Callable[[DataFrame], DataFrame]:
    """A function of requests (with a column url) that adds status, content_type and body, rows in the order they came in.

    make_call gives a task its callable from a url to a Response, so that clients are made where they are
    used. An exception of a call gives status -1, so one failure doesn't end a task; a throttled server does.
    """
    import pyarrow as pa

    def run(batches):
        call = make_call()

        def one(url):
            try:
                return call(url)
            except ThrottledError:
                raise
            except Exception as e:  # noqa: BLE001  (the fault becomes the row's outcome)
                return Response(-1, type(e).__name__)

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                found = list(pool.map(one, batch.column("url").to_pylist()))
                made = [pa.array([x.status for x in found], pa.int32()), pa.array([x.content_type for x in found], pa.string()), pa.array([x.body for x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "status", "content_type", "body"])

    added = [T.StructField("status", T.IntegerType()), T.StructField("content_type", T.StringType()), T.StructField("body", T.BinaryType())]
    return lambda requests: requests.mapInArrow(run, T.StructType([*requests.schema.fields, *added]))


#: Ids that one request asks for.
IDS_A_REQUEST = 30


def request_batches(wanted: DataFrame, key: str, size: int = IDS_A_REQUEST) -> DataFrame:
    """batch (from 0) and ids: distinct ids in ascending order, so many to a request and fewer only in the last.

    Places in the order are counted within ranges of it and added up over the ranges; no task sees all ids, and a group has no more than size.
    """
    ids = wanted.filter(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
    placed = deck.running_kept(ids, "id", F.lit(True)).select("id", F.floor(F.col("kept_before") / size).cast("long").alias("batch"))
    return placed.groupBy("batch").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def json_fault(status: Column, content_type: Column, body: Column) -> Column:
    """The first fault of a response that should be a JSON object; null if it is one. A page of HTML served with status 200 is a fault."""
    text = body.cast("string")
    return ledger.first_reason(
        (~status.eqNullSafe(F.lit(200)), "http_error"), (~F.coalesce(F.lower(content_type).contains("json"), F.lit(False)), "not_json"),
        (F.try_parse_json(text).isNull(), "undecodable"), (~F.ltrim(text).startswith("{"), "not_an_object"),
    )


def plain_json(value: Column, kind: T.DataType, path: str = "$", fraction: str = "auto") -> Column:
    """The value in kinds that JSON keeps: dates and times as ISO text. A kind that has no JSON form is an error that names its place.

    fraction: auto leaves out microseconds that are all zero, always writes them.
    """
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[plain_json(value[f.name], f.dataType, f"{path}.{f.name}", fraction).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: plain_json(x, kind.elementType, f"{path}[*]", fraction))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError(f"{path} has keys of type {kind.keyType.simpleString()}, which have no JSON form")
        return F.transform_values(value, lambda k, x: plain_json(x, kind.valueType, f"{path}.*", fraction))
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zone = "XXX" if isinstance(kind, T.TimestampType) else ""
        full = F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}")
        return full if fraction == "always" else F.when(F.date_format(value, "SSSSSS") == "000000", F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{zone}")).otherwise(full)
    if isinstance(kind, (T.StringType, T.BooleanType, T.NullType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return value
    raise TypeError(f"{path} has type {kind.simpleString()}, which has no JSON form")


#: What a cache's folders hold: one JSON object a line, the response as text, so that any endpoint fits.
ENTRIES = "key string, endpoint string, params map<string,string>, projection_version int, fetched_at string, response string"


def cached(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a cache, none for a cache that isn't there yet."""
    if not exists(spark, f"{path}/entries"):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).option("mode", "FAILFAST").json(f"{path}/entries")


def read_through(requests: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame] | None, project: Callable[[Column], Column], version: int, keep_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """(entries for the requests, counters: endpoint, hits, misses).

    requests: key, endpoint, params (a map) and what fetch needs. fetch adds status, content_type and body;
    without it the scan is offline, and a request that isn't cached is an error, as is a response with a
    fault. project makes the JSON text that is kept of a body. keep_raw also keeps the whole bodies, which are never read back.
    """
    from granary.session import cut

    spark = requests.sparkSession
    wanted = cut(requests.dropDuplicates(["key"]))
    known = cached(spark, path).filter(F.col("projection_version") == version).select(F.col("key").alias("known")).distinct()
    marked = cut(wanted.join(known, F.col("key") == F.col("known"), "left"))
    counters = marked.groupBy("endpoint").agg(F.count("known").alias("hits"), F.count_if(F.col("known").isNull()).alias("misses"))
    missing = marked.filter("known IS NULL").drop("known")
    if not missing.isEmpty():
        if fetch is None:
            first = missing.orderBy("key").first()
            raise CacheMissError(f"no cached response for {first.endpoint} {first.params}")
        found = cut(fetch(missing).withColumn("fault", json_fault(F.col("status"), F.col("content_type"), F.col("body"))))
        bad = found.filter("fault IS NOT NULL").select("endpoint", "params", "fault").first()
        if keep_raw:
            found.filter("fault IS NULL").select("key", "endpoint", F.col("body").cast("string").alias("body")).write.mode("append").partitionBy("endpoint").json(f"{path}/raw")
        body = project(F.col("body").cast("string"))
        rows = found.filter("fault IS NULL").select("key", *[c for c in ENVELOPE[:2]], F.lit(version).alias("projection_version"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"), body.alias("response"))
        rows.write.mode("append").json(f"{path}/entries")  # what was fetched stays, even if another request failed
        if bad is not None:
            raise ValueError(f"{bad.endpoint} {bad.params}: {bad.fault}")
    entries = cached(spark, path).filter(F.col("projection_version") == version).dropDuplicates(["key"])
    return entries.join(wanted.select("key"), "key", "left_semi"), cut(counters)


def cost_summary(counters: DataFrame) -> DataFrame:
    """One line: requests, cached, fetched, and the fetched ones of each endpoint."""
    each = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("misses") > 0, F.struct("endpoint", "misses")))), lambda x: F.concat_ws("=", x["endpoint"], x["misses"].cast("string"))), ", ")
    sums = counters.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("h"), F.coalesce(F.sum("misses"), F.lit(0)).alias("m"), each.alias("each"))
    line = F.format_string("%d requests: %d cached, %d fetched", F.col("h") + F.col("m"), F.col("h"), F.col("m"))
    return sums.select(F.concat(line, F.when(F.col("each") != "", F.concat(F.lit(" ("), F.col("each"), F.lit(")"))).otherwise("")).alias("line"))


def file_version(spark: SparkSession, path: str) -> DataFrame:
    """One row: the date of the oldest file below a path, today if there is none; from metadata alone."""
    if not exists(spark, path):
        return spark.range(1).select(F.current_date().alias("version"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("modificationTime")
    return files.agg(F.coalesce(F.to_date(F.min("modificationTime")), F.current_date()).alias("version"))
