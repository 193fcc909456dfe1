"""Content addressing, reuse and garbage collection on documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import store
from granary.plans.query import Registry
from granary.session import table

R = Registry()


@R.query("""SELECT doc_id, sha256('{"endpoint":"documents","params":{"lang":"' || lang || '","source":"' || source || '"},"projection_version":1}') AS cache_key FROM documents""")
def cache_key_sha256(spark, sf_dir):
    """SHA-256 of the canonical, sorted, compact JSON of a request."""
    from granary.sources.cache import cache_key

    return table(spark, sf_dir, "documents").select("doc_id", cache_key("documents", {"source": F.col("source"), "lang": F.col("lang")}, 1).alias("cache_key"))


@R.query("SELECT sha256(text) AS sha256, strlen(any_value(text)) AS bytes FROM documents GROUP BY 1")
def content_address_dedup(spark, sf_dir):
    rows = store.addressed(table(spark, sf_dir, "documents").select("text"), "text").select("sha256", F.octet_length("text").cast("long").alias("bytes"))
    return rows.groupBy("sha256").agg(F.first("bytes").alias("bytes"))


@R.query("SELECT left(sha256(text), 2) AS shard, count(DISTINCT sha256(text)) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM (SELECT DISTINCT text FROM documents) GROUP BY 1")
def store_shards(spark, sf_dir):
    rows = store.addressed(table(spark, sf_dir, "documents").select("text"), "text").groupBy("sha256", "shard").agg(F.first(F.octet_length("text")).alias("bytes"))
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").cast("long").alias("bytes"))


@R.query("""WITH w AS (SELECT DISTINCT source, sha256(text) AS h FROM documents), s AS (SELECT DISTINCT source, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 7)
SELECT w.source, count(*) AS n_wanted, count(s.h) = count(*) AS reuse FROM w LEFT JOIN s USING (source, h) GROUP BY 1""")
def incremental_reuse(spark, sf_dir):
    """A source is reused if everything it wants was settled in an earlier run, here a run that lacked some documents."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2("text", 256).alias("h"))
    return store.reusable(rows, rows.filter("doc_id % 10 <> 7"), "source", "h")


@R.query("SELECT DISTINCT sha256(text) AS sha256 FROM documents EXCEPT SELECT sha256(text) FROM documents WHERE lang = 'en'")
def gc_unreferenced(spark, sf_dir):
    rows = store.addressed(table(spark, sf_dir, "documents").select("text", "lang"), "text").select("sha256", "lang")
    return store.garbage(rows, rows.filter("lang = 'en'"))


@R.query("""SELECT doc_id, coalesce(l.quality, CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END) AS quality, CASE WHEN l.doc_id IS NULL THEN 'seed' ELSE 'journal' END AS origin
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def union_latest(spark, sf_dir):
    """An earlier run's rows, overridden by the journal's."""
    seed = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("quality"), F.lit("seed").alias("origin"), F.lit(0).alias("priority"))
    journal = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit("journal").alias("origin"), F.lit(1).alias("priority"))
    return store.latest(seed.union(journal), "doc_id", "priority").select("doc_id", "quality", "origin")
