"""Joins, entity resolution, claim fusion and promotion on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.text import classify_status, establishment_value, loose_name
from granary.operators import claims, promote
from granary.plans.query import Registry
from granary.session import table

R = Registry()


@R.query("SELECT doc_id, 'detail_unavailable' AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def detail_anti_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").withColumn("reason", F.lit("detail_unavailable"))


@R.query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def summary_detail_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")


@R.query("SELECT d.doc_id, l.quality, CASE WHEN l.doc_id IS NULL THEN 'absent_from_response' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_outer_reason(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("found"))
    rows = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.select("doc_id", "quality", F.when(F.col("found").isNull(), "absent_from_response").alias("reason"))


@R.query("""SELECT c_custkey, CASE WHEN s.s_nationkey IS NOT NULL AND c.c_nationkey IS NOT DISTINCT FROM s.s_nationkey THEN c_mktsegment END AS value,
CASE WHEN c.c_nationkey IS DISTINCT FROM s.s_nationkey THEN 'place_not_state_scoped' END AS reason FROM customer c LEFT JOIN supplier s ON c_custkey = s_suppkey""")
def place_scope_guard(spark, sf_dir):
    """The answered place must be the asked one; a missing place is another place."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "left")
    return rows.select("c_custkey", claims.scoped(F.col("c_mktsegment"), F.col("s_nationkey"), F.col("c_nationkey")).alias("s")).select("c_custkey", "s.value", "s.reason")


def _records(spark, sf_dir):
    """Parts as name records: a brand's spelling of a name; some are synonyms of another symbol."""
    part = table(spark, sf_dir, "part")
    spelled = F.when(F.col("p_size") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return part.select(
        F.col("p_partkey").alias("symbol"), spelled.alias("name"), (F.col("p_size") % 5 == 0).alias("is_synonym"),
        F.when(F.col("p_size") % 5 == 0, F.col("p_partkey") - F.col("p_partkey") % 10).otherwise(F.col("p_partkey")).alias("target"), "p_type", "p_brand",
    )


def _wanted(spark, sf_dir):
    """Names to resolve: every part's, within its brand."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", F.col("p_brand").alias("brand"))


def _group(brand: str, name):
    return F.struct(F.col(brand).alias("brand"), name.alias("name")).alias("group")


def _offered(spark, sf_dir):
    """The records by the groups they may be found in: tiers 1 and 2 by their own spelling, 3 by the loose one. A brand's name alike is one group."""
    records = _records(spark, sf_dir).filter("name IS NOT NULL AND p_brand IS NOT NULL")
    exact = F.struct(F.when(~F.col("is_synonym"), 1).otherwise(2).alias("tier"), _group("p_brand", F.col("name")))
    loose = F.struct(F.lit(3).alias("tier"), _group("p_brand", loose_name(F.col("name"))))
    value = F.when(~F.col("p_type").isin("PROMO", "SMALL"), F.col("p_type")).alias("value")
    return records.select("target", value, F.explode(F.array(exact, loose)).alias("g")).select("g.*", "target", "value")


def _matches(spark, sf_dir):
    """(ids with the groups of their lowest tier, the records of all groups)."""
    names = _wanted(spark, sf_dir).filter("p_name IS NOT NULL AND brand IS NOT NULL")
    exact, loose = _group("brand", F.col("p_name")), _group("brand", loose_name(F.col("p_name")))
    tiers = F.explode(F.array(F.struct(F.lit(1).alias("tier"), exact), F.struct(F.lit(2).alias("tier"), exact), F.struct(F.lit(3).alias("tier"), loose)))
    offered = _offered(spark, sf_dir)
    return claims.best_groups(names.select("id", tiers.alias("g")).select("id", "g.*"), offered, "id"), offered


_MATCHES = """records AS (SELECT p_partkey AS symbol, CASE WHEN p_size % 3 = 0 THEN upper(p_name) ELSE p_name END AS name, p_size % 5 = 0 AS is_synonym,
  CASE WHEN p_size % 5 = 0 THEN p_partkey - p_partkey % 10 ELSE p_partkey END AS target, p_type, p_brand FROM part),
met AS (SELECT w.p_partkey AS id, r.*, CASE WHEN name = w.p_name AND NOT is_synonym THEN 1 WHEN name = w.p_name THEN 2 ELSE 3 END AS tier
  FROM part w JOIN records r ON lower(w.p_name) = lower(r.name) AND w.p_brand = r.p_brand),
matches AS (SELECT * FROM met QUALIFY tier = min(tier) OVER (PARTITION BY id))"""


@R.query(f"WITH {_MATCHES} SELECT DISTINCT id, tier::INT AS tier, target, CASE WHEN tier = 3 THEN 'medium' ELSE 'high' END AS confidence FROM matches")
def tiered_match(spark, sf_dir):
    confidence = F.when(F.col("tier") == 3, claims.TIER_CONFIDENCE[3]).otherwise(claims.TIER_CONFIDENCE[1])
    return claims.expanded(*_matches(spark, sf_dir), "id", "target").select("id", "tier", "target", confidence.alias("confidence"))


_CONSENSUS = f"""{_MATCHES}, outcomes AS (SELECT DISTINCT id, target, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL ELSE p_type END AS value FROM matches),
agreed AS (SELECT id, min(target) AS symbol, count(*) AS n_targets, count(DISTINCT value) + max((value IS NULL)::INT) AS n, max(value) AS v FROM outcomes GROUP BY 1)"""


@R.query(f"""WITH {_CONSENSUS} SELECT id, symbol, CASE WHEN n = 1 THEN v END AS value, n_targets, CASE WHEN n <> 1 THEN 'ambiguous_match' WHEN v IS NULL THEN 'no_status' END AS reason FROM agreed""")
def homonym_consensus(spark, sf_dir):
    """Homonyms are accepted if all agree; no value is a value of its own."""
    return claims.group_consensus(*_matches(spark, sf_dir), "id", "target", "value")


@R.query(f"WITH {_MATCHES}, v AS (SELECT unnest([1, 2, 3]) AS tier), ids AS (SELECT DISTINCT id, tier FROM matches) SELECT v.tier, count(i.id) AS n FROM v LEFT JOIN ids i USING (tier) GROUP BY 1")
def tier_counts(spark, sf_dir):
    tiers = spark.createDataFrame([(t,) for t in claims.TIER_CONFIDENCE], "tier int")
    found = _matches(spark, sf_dir)[0].select("id", "tier").distinct().groupBy("tier").agg(F.count(F.lit(1)).alias("n"))
    return tiers.join(found, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"))


def _fused(spark, sf_dir):
    """Two sources on a document's quality: labels, and its length; both are silent on some."""
    ref = lambda name: F.array(F.struct(F.lit(name).alias("name"), F.lit("1").alias("version")))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"), F.when(F.col("quality") == 1, "good").otherwise("poor").alias("v"))
    length = F.when(F.col("n_chars") > 2000, "good").when(F.col("n_chars") < 600, "poor")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", length.alias("w")).join(labels, F.col("doc_id") == F.col("labelled"), "left")
    first = F.struct(F.col("v").alias("value"), F.when(F.col("v") == "good", "high").when(F.col("v").isNotNull(), "medium").alias("confidence"), ref("labels").alias("sources"))
    second = F.struct(F.col("w").alias("value"), F.lit("high").alias("confidence"), ref("length").alias("sources"))
    rows = rows.withColumn("first", first).withColumn("second", second)
    return rows.select("doc_id", "source", *[c.alias(k) for k, c in claims.fuse("first", "second").items()])


_FUSED = """two AS (SELECT d.doc_id, d.source, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS v, CASE WHEN n_chars > 2000 THEN 'good' WHEN n_chars < 600 THEN 'poor' END AS w
  FROM documents d LEFT JOIN labels l USING (doc_id)),
fused AS (SELECT doc_id, source, v, w, CASE WHEN v = w THEN 'agreement' WHEN v IS NOT NULL AND w IS NOT NULL THEN 'conflict' WHEN v IS NULL AND w IS NULL THEN 'no_source' ELSE 'single_source' END AS outcome FROM two),
decided AS (SELECT doc_id, source, outcome, CASE WHEN outcome IN ('agreement', 'single_source') THEN coalesce(v, w) END AS value,
  CASE outcome WHEN 'agreement' THEN CASE v WHEN 'good' THEN 'high' ELSE 'medium' END WHEN 'single_source' THEN 'medium' END AS confidence,
  CASE outcome WHEN 'agreement' THEN 'labels,length' WHEN 'single_source' THEN CASE WHEN v IS NULL THEN 'length' ELSE 'labels' END END AS sources,
  CASE outcome WHEN 'conflict' THEN 'source_conflict' WHEN 'no_source' THEN 'no_nativity_source' END AS reason FROM fused)"""


@R.query(f"WITH {_FUSED} SELECT doc_id, outcome, value, confidence, sources, reason FROM decided")
def two_source_fusion(spark, sf_dir):
    names = F.array_join(F.transform("sources", lambda s: s["name"]), ",")
    return _fused(spark, sf_dir).select("doc_id", "outcome", "value", "confidence", names.alias("sources"), "reason")


@R.query(f"""WITH {_FUSED}, v AS (SELECT unnest(['agreement', 'conflict', 'single_source', 'no_source']) AS outcome)
SELECT v.outcome, count(d.doc_id) AS n, min(d.doc_id) AS first_id FROM v LEFT JOIN decided d USING (outcome) GROUP BY 1""")
def fusion_report(spark, sf_dir):
    outcomes = spark.createDataFrame([(x,) for x in claims.OUTCOMES], "outcome string")
    counts = _fused(spark, sf_dir).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    return outcomes.join(counts, "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"), "first_id")


@R.query(f"""WITH {_FUSED} SELECT count(*) FILTER (outcome = 'agreement') || ' agreed, ' || count(*) FILTER (outcome = 'conflict') || ' conflicted, ' || count(*) FILTER (outcome = 'single_source') || ' single-source, ' ||
count(*) FILTER (outcome = 'no_source') || ' unsourced' AS line FROM decided""")
def fusion_line(spark, sf_dir):
    return claims.fusion_summary(_fused(spark, sf_dir))


@R.query(f"WITH {_FUSED} SELECT source, CASE WHEN bool_or(confidence = 'medium') THEN 'medium' ELSE max(confidence) END AS weakest FROM decided GROUP BY 1")
def weakest_confidence(spark, sf_dir):
    rank = F.array_position(F.array(*[F.lit(x) for x in claims.CONFIDENCE]), F.col("confidence"))
    rows = _fused(spark, sf_dir).withColumn("rank", rank)
    return rows.groupBy("source").agg(F.min_by("confidence", "rank").alias("weakest"))


@R.query("SELECT conv_id, role, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def last_wins_map(spark, sf_dir):
    return claims.last_wins(table(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), ["conv_id"], "turn")


@R.query("""WITH c AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'N' WHEN 'F' THEN 'I' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'N?' WHEN o_orderkey % 3 = 1 THEN 'NI' END END AS code FROM orders)
SELECT o_orderkey, CASE code WHEN 'N' THEN 'native' WHEN 'I' THEN 'introduced' END AS value,
CASE code WHEN 'N?' THEN 'uncertain_native_status' WHEN 'NI' THEN 'conflicting_native_status' ELSE CASE WHEN code IS NULL THEN 'no_native_status' END END AS reason FROM c""")
def status_codes(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    code = F.when(F.col("o_orderstatus") == "O", "N").when(F.col("o_orderstatus") == "F", "I").when(k == 0, "N?").when(k == 1, "NI")
    return table(spark, sf_dir, "orders").select("o_orderkey", classify_status(code).alias("s")).select("o_orderkey", "s.value", "s.reason")


@R.query("""SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'native' WHEN event_type = 'signup' THEN 'introduced' END AS value FROM events""")
def establishment_values(spark, sf_dir):
    raw = F.when(F.col("event_type") == "view", "native").when(F.col("event_type") == "click", "endemic").when(F.col("event_type") == "signup", "introduced").otherwise("managed")
    return table(spark, sf_dir, "events").select("event_id", establishment_value(raw).alias("value"))


@R.query("""SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3)""")
def exclusion_anti(spark, sf_dir):
    excluded = table(spark, sf_dir, "nation").filter("n_regionkey = 3").select(F.col("n_nationkey").alias("c_nationkey"))
    kept, _ = promote.exclude(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), excluded, ["c_nationkey"])
    return kept


@R.query("SELECT c_custkey, CASE WHEN n_regionkey IN (1, 4) THEN 'genus' ELSE 'species' END AS answer_rank FROM customer JOIN nation ON c_nationkey = n_nationkey")
def genus_demotion(spark, sf_dir):
    listed = table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(1, 4)).select(F.col("n_nationkey").alias("c_nationkey"))
    return promote.answer_rank(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), listed, "c_nationkey").select("c_custkey", "answer_rank")


@R.query(f"""WITH {_FUSED} SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'excluded' WHEN value IS NULL THEN reason END AS reason,
CASE WHEN doc_id % 11 <> 0 AND value IS NOT NULL THEN 'promoted' ELSE 'unmatched' END AS decision FROM decided""")
def promote_documents(spark, sf_dir):
    fused = _fused(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id")
    found = fused.filter("value IS NOT NULL").select("doc_id", "value")
    why = fused.filter("reason IS NOT NULL").select("doc_id", "reason")
    return promote.promote(docs, "doc_id", docs.filter("doc_id % 11 = 0"), found, why).select("doc_id", "reason", "decision")
