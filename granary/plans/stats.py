"""Exact statistics on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import ledger, stats
from granary.functions.text import human_bytes
from granary.plans.query import Registry
from granary.session import table

R = Registry()


@R.query("SELECT o_orderpriority AS license, count(*) AS n FROM orders GROUP BY 1")
def license_histogram(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("license")), "license")


@R.query("SELECT o_orderpriority AS license, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS share_pct FROM orders GROUP BY 1")
def share_pct(spark, sf_dir):
    return stats.with_share(license_histogram(spark, sf_dir))


@R.query("""SELECT l_suppkey, list_sort(list(l_quantity))[1 + round_even(0.1 * (count(*) - 1), 0)::BIGINT] AS p10 FROM lineitem GROUP BY 1""")
def nearest_rank_p10(spark, sf_dir):
    return stats.nearest_rank(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity"), ["l_suppkey"], "l_quantity", 0.1, "p10")


@R.query("""SELECT l_returnflag, list_sort(list(l_extendedprice))[1 + round_even(0.9 * (count(*) - 1), 0)::BIGINT] AS p90 FROM lineitem GROUP BY 1""")
def nearest_rank_price(spark, sf_dir):
    """Few groups with nearly as many distinct values as rows."""
    return stats.nearest_rank(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", 0.9, "p90")


@R.query("SELECT l_suppkey, trunc(median(l_quantity))::BIGINT AS median_quantity FROM lineitem GROUP BY 1")
def median_trunc(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(stats.truncated_median(F.col("l_quantity")).alias("median_quantity"))


@R.query("SELECT count(*) FILTER (n <= 5) AS thin, count(*) FILTER (n > 5) AS rich FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def thin_rich(spark, sf_dir):
    return stats.thin_rich(table(spark, sf_dir, "lineitem"), "l_orderkey")


@R.query("""SELECT o_custkey, CASE WHEN s < 1024 THEN s || ' B' WHEN s < 1048576 THEN printf('%.1f KB', s / 1024.0) ELSE printf('%.1f MB', s / 1048576.0) END AS size
FROM (SELECT o_custkey, CAST(sum(o_orderkey) AS BIGINT) AS s FROM orders GROUP BY 1)""")
def human_sizes(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_orderkey").alias("s"))
    return sums.select("o_custkey", human_bytes(F.col("s")).alias("size"))


@R.query("""SELECT lang, count(*) AS considered, count(l.doc_id) AS kept, count(*) - count(l.doc_id) AS dropped FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def considered_counts(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(labels, F.col("doc_id") == F.col("labelled"), "left")
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("considered"), F.count("labelled").alias("kept"), F.count_if(F.col("labelled").isNull()).alias("dropped"))


@R.query("""WITH v AS (SELECT unnest(['high', 'medium', 'none']) AS confidence), c AS (SELECT CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'medium' END AS confidence FROM labels)
SELECT v.confidence, count(c.confidence) AS n FROM v LEFT JOIN c USING (confidence) GROUP BY 1""")
def confidence_zero_fill(spark, sf_dir):
    graded = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "medium").alias("confidence"))
    return ledger.zero_filled(graded, ("high", "medium", "none"), "confidence")
