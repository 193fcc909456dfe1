"""Ranked selection, sampling and integrity constraints on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import constraints as C
from granary.operators import deck, ledger, sampling
from granary.plans.query import Registry
from granary.session import table

R = Registry()
#: A part ordered fewer times is rejected as too rare; so many are kept.
FLOOR, LIMIT = 30, 300
REASONS = ("hybrid", "not_species_rank", "below_floor")


def _ranked(spark, sf_dir):
    """Parts by number of lineitems, most first, ties by key: place, part, count, reason."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type").join(counts, F.col("p_partkey") == F.col("l_partkey"))
    reason = ledger.first_reason(
        (F.lower("p_name").contains("gizmo"), "hybrid"), (F.col("p_type") == "PROMO", "not_species_rank"), (F.col("n_lines") < FLOOR, "below_floor")
    )
    # the order as one number: counts are far below 2 ** 31, keys below 2 ** 32
    order = -F.col("n_lines") * F.lit(1 << 32) + F.col("p_partkey")
    return parts.select("p_partkey", "p_name", "n_lines", reason.alias("reason"), order.alias("ord"))


_RANKED = f"""
counts AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1),
ranked AS (
  SELECT p_partkey, p_name, n_lines, CASE WHEN lower(p_name) LIKE '%gizmo%' THEN 'hybrid' WHEN p_type = 'PROMO' THEN 'not_species_rank' WHEN n_lines < {FLOOR} THEN 'below_floor' END AS reason
  FROM part JOIN counts ON p_partkey = l_partkey),
placed AS (
  SELECT *, coalesce(sum((reason IS NULL)::INT) OVER (ORDER BY n_lines DESC, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ranked),
reached AS (SELECT * FROM placed WHERE ahead < {LIMIT})"""


@R.query(f"WITH {_RANKED} SELECT p_partkey, p_name, n_lines FROM reached WHERE reason IS NULL")
def deck_ranked(spark, sf_dir):
    kept, _ = ledger.split(deck.ranked_prefix(_ranked(spark, sf_dir), "ord", "reason", LIMIT))
    return kept.select("p_partkey", "p_name", "n_lines")


@R.query(f"WITH {_RANKED} SELECT p_partkey, reason, p_name || ' has ' || n_lines || ' rows' AS detail FROM reached WHERE reason IS NOT NULL")
def deck_drop_ledger(spark, sf_dir):
    _, dropped = ledger.split(deck.ranked_prefix(_ranked(spark, sf_dir), "ord", "reason", LIMIT))
    return dropped.select("p_partkey", "reason", F.format_string("%s has %d rows", "p_name", "n_lines").alias("detail"))


@R.query(f"WITH {_RANKED}, v AS (SELECT unnest({list(REASONS) + ['unreachable']}) AS reason) SELECT v.reason, count(r.p_partkey) AS n FROM v LEFT JOIN reached r USING (reason) GROUP BY 1")
def drop_reason_zero_fill(spark, sf_dir):
    _, dropped = ledger.split(deck.ranked_prefix(_ranked(spark, sf_dir), "ord", "reason", LIMIT))
    return ledger.zero_filled(dropped, (*REASONS, "unreachable"))


@R.query("SELECT min(doc_id) AS doc_id, sha256(text) AS sha256, count(*) AS n FROM documents GROUP BY 2")
def first_occurrence_dedup(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return keyed.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).select("doc_id", "sha256", "n")


@R.query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE r = 1")
def cross_bucket_first(spark, sf_dir):
    return deck.first_occurrence(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], [F.col("turn")])


_BUCKET = "CASE WHEN month(l_shipdate) BETWEEN 3 AND 5 THEN 'A' WHEN month(l_shipdate) IN (6, 7) THEN 'B' WHEN month(l_shipdate) IN (8, 9) THEN 'C' ELSE 'D' END"


def _lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    item = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return lines.select("l_partkey", "l_suppkey", item.alias("item"), sampling.month_bucket(F.col("l_shipdate")).alias("bucket"), "l_quantity", "l_shipdate")


@R.query(f"SELECT {_BUCKET} AS bucket, count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def month_bucket_yield(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts"))


@R.query(f"""WITH v AS (SELECT unnest(['A', 'B', 'C', 'D']) AS bucket), e AS (SELECT {_BUCKET.replace('l_shipdate', 'ts')} AS bucket FROM events)
SELECT v.bucket, count(e.bucket) AS n FROM v LEFT JOIN e USING (bucket) GROUP BY 1""")
def bucket_zero_fill(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(sampling.month_bucket(F.col("ts")).alias("bucket"))
    return ledger.zero_filled(events, sampling.BUCKETS, "bucket")


_ITEMS = f"items AS (SELECT l_partkey, l_suppkey, l_orderkey * 10 + l_linenumber AS item, {_BUCKET} AS bucket FROM lineitem)"


@R.query(f"""WITH {_ITEMS}, turns AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, bucket ORDER BY item) AS turn FROM (SELECT DISTINCT l_partkey, item, bucket FROM items)),
placed AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY turn, bucket) AS place FROM turns)
SELECT l_partkey, bucket, item, place FROM placed WHERE place <= 8""")
def round_robin_uncapped(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("l_partkey", "bucket", "item").distinct()
    return sampling.round_robin(lines, "l_partkey", "bucket", "item")


@R.query(f"""WITH RECURSIVE {_ITEMS}, g AS (SELECT l_partkey, list({{'i': item, 'b': bucket, 'o': l_suppkey}} ORDER BY item, bucket, l_suppkey) AS a FROM (SELECT DISTINCT * FROM items) GROUP BY 1),
f(l_partkey, a, k, acc) AS (
  SELECT l_partkey, a, 0, a[1:0] FROM g
  UNION ALL
  SELECT l_partkey, a, k + 1, CASE WHEN len(acc) >= 8 THEN acc ELSE list_concat(acc, list_filter(a, lambda x: x.b = ['A', 'B', 'C', 'D'][k % 4 + 1]
    AND len(list_filter(acc, lambda t: t.i = x.i)) = 0 AND len(list_filter(acc, lambda t: t.o = x.o)) < 2)[1:1]) END FROM f WHERE k < 32)
SELECT l_partkey, list_aggregate(list_transform(acc, lambda x: x.b || ':' || x.i), 'string_agg', ' ') AS chosen FROM f WHERE k = 32""")
def round_robin_capped(spark, sf_dir):
    lines = _lines(spark, sf_dir).select("l_partkey", "bucket", "l_suppkey", "item").distinct()
    out = sampling.round_robin_capped(lines, "l_partkey", "bucket", "l_suppkey", "item")
    return out.select("l_partkey", F.array_join(F.transform("chosen", lambda x: F.concat_ws(":", x["b"], x["i"])), " ").alias("chosen"))


@R.query(f"SELECT l_partkey, count(*) AS n, CASE WHEN count(*) < {FLOOR} THEN 'insufficient_support' END AS reason FROM lineitem GROUP BY 1")
def min_support_drop(spark, sf_dir):
    counts = _lines(spark, sf_dir).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("reason", F.when(F.col("n") < FLOOR, "insufficient_support"))


@R.query(f"SELECT l_partkey, count(DISTINCT {_BUCKET}) AS months_represented, count(DISTINCT l_suppkey) AS distinct_observers FROM lineitem GROUP BY 1")
def quality_signals(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_partkey").agg(F.count_distinct("bucket").alias("months_represented"), F.count_distinct("l_suppkey").alias("distinct_observers"))


@R.query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 2")
def observer_cap_violations(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > sampling.OWNER_CAP)


@R.query("SELECT o_orderkey, lower(o_orderpriority) AS license FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '2-high', '5-low')")
def license_whitelist(spark, sf_dir):
    code = F.lower("o_orderpriority")
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("license")).filter(F.col("license").isin("1-urgent", "2-high", "5-low"))


@R.query("SELECT o_custkey, min(o_orderkey) AS first_usable FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def first_usable(spark, sf_dir):
    """First usable entry in list order."""
    usable = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return usable.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_usable"))


@R.query("""SELECT 'duplicate_order' AS "constraint", o_orderkey::VARCHAR AS key FROM orders GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'dangling_part', l_partkey::VARCHAR FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
UNION ALL SELECT 'orphan_part', p_partkey::VARCHAR FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)
UNION ALL SELECT 'customer_without_orders', c_custkey::VARCHAR FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def referential_integrity(spark, sf_dir):
    """Constraints over four tables from one scan of each and one count."""
    part, lines, orders, customer = (table(spark, sf_dir, t) for t in ("part", "lineitem", "orders", "customer"))
    said = [
        C.facts(orders, ("order", "left", F.col("o_orderkey")), ("customer", "right", F.col("o_custkey"))),
        C.facts(lines, ("part", "left", F.col("l_partkey")), ("bulk", "left", F.col("l_partkey"), F.col("l_quantity") >= 49)),
        C.facts(part, ("part", "right", F.col("p_partkey"), F.col("p_size") <= 40), ("bulk", "right", F.col("p_partkey"))),
        C.facts(customer, ("customer", "left", F.col("c_custkey"))),
    ]
    return C.broken(said, {
        "duplicate_order": ("order", C.repeated()), "dangling_part": ("part", C.alone("left")), "orphan_part": ("bulk", C.alone("right")), "customer_without_orders": ("customer", C.alone("left")),
    })


@R.query("""SELECT 'duplicate_name' AS "constraint", p_name AS key FROM part GROUP BY p_name HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return C.unique(table(spark, sf_dir, "part"), "p_name", "duplicate_name")


@R.query("""SELECT 'kept_and_dropped' AS "constraint", l_suppkey::VARCHAR AS key FROM (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'A')""")
def kept_dropped_disjoint(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return C.disjoint(lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag = 'A'"), "l_suppkey", "kept_and_dropped")


@R.query(f"WITH {_RANKED} SELECT count(*) AS n_rows, count(reason) AS n_dropped, count(*) - count(reason) AS n_kept, 0::BIGINT AS n_faults FROM reached")
def promotion_partition(spark, sf_dir):
    """Kept and dropped partition what was considered."""
    whole = deck.ranked_prefix(_ranked(spark, sf_dir), "ord", "reason", LIMIT)
    kept, dropped = ledger.split(whole)
    faults = ledger.partition_faults(whole, kept, dropped, "p_partkey").agg(F.count(F.lit(1)).alias("n_faults"))
    sums = whole.agg(F.count(F.lit(1)).alias("n_rows"), F.count("reason").alias("n_dropped"), F.count_if(F.col("reason").isNull()).alias("n_kept"))
    return sums.join(faults)


@R.query("""SELECT 'order_lines' AS "constraint", l_orderkey::VARCHAR AS key FROM lineitem GROUP BY l_orderkey HAVING count(*) < 2 OR count(*) > 8""")
def cardinality_bounds(spark, sf_dir):
    return C.cardinality(table(spark, sf_dir, "lineitem"), "l_orderkey", 2, 8, "order_lines")


@R.query("""SELECT 'label_xor' AS "constraint", doc_id::VARCHAR AS key FROM (SELECT d.doc_id, CASE WHEN n_chars > 500 THEN 'long' END AS claim, CASE WHEN lang <> 'en' THEN 'foreign' END AS reason FROM documents d) WHERE (claim IS NULL) = (reason IS NULL)""")
def claim_xor_reason(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 500, "long").alias("claim"), F.when(F.col("lang") != "en", "foreign").alias("reason"))
    return C.exactly_one(docs, ["claim", "reason"], "doc_id", "label_xor")


@R.query("""SELECT 'version' AS "constraint", doc_id::VARCHAR AS key FROM documents WHERE n_chars % 4 <> 1""")
def version_faults(spark, sf_dir):
    """Rows written under another version than this build's; older ones aren't upgraded."""
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 4).alias("version"))
    return C.checks(rows, "doc_id", {"version": F.col("version") == 1})


@R.query("""SELECT 'no_text' AS "constraint", doc_id::VARCHAR AS key FROM documents WHERE n_chars < 200 UNION ALL SELECT 'unnamed_source', doc_id::VARCHAR FROM documents WHERE source NOT LIKE 'src1%'
UNION ALL SELECT 'language', doc_id::VARCHAR FROM documents WHERE lang NOT IN ('en', 'de')""")
def row_constraints(spark, sf_dir):
    """Several conditions on one table's rows in one scan, every broken one reported."""
    docs = table(spark, sf_dir, "documents")
    return C.checks(docs, "doc_id", {"no_text": F.col("n_chars") >= 200, "unnamed_source": F.col("source").startswith("src1"), "language": F.col("lang").isin("en", "de")})
