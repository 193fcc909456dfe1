"""Nested projections on JSON made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import constraints, guards, nested
from granary.plans.query import Registry
from granary.session import table
from granary.sources import tables

R = Registry()


@R.query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_projection(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))


@R.query("SELECT event_id, json_extract_string(props, '$.missing') AS missing, json_extract(props, '$.missing') IS NULL AS is_absent FROM events")
def json_absence(spark, sf_dir):
    value = F.get_json_object("props", "$.missing")
    return table(spark, sf_dir, "events").select("event_id", value.alias("missing"), value.isNull().alias("is_absent"))


@R.query("SELECT event_id, array_to_string(list_filter(json_keys(props), lambda k: k <> 'value'), ',') AS unknown FROM events")
def strict_keys(spark, sf_dir):
    """Keys that a closed schema (value) doesn't know."""
    return table(spark, sf_dir, "events").select("event_id", F.array_join(constraints.unknown_keys(F.col("props"), ["value"]), ",").alias("unknown"))


@R.query("""SELECT o_custkey AS id, list_sort(list(o_orderkey))[1] AS first_id, count(*) AS n_results FROM orders GROUP BY 1""")
def project_results(spark, sf_dir):
    """A response body built of a customer's orders and projected again: number and order of results stay."""
    entry = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.lit("ignored").alias("extra"))
    bodies = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(F.array_sort(F.collect_list(entry)).alias("results"))).alias("body"))
    out = bodies.select(F.col("o_custkey").alias("id"), nested.project(F.col("body"), "places_autocomplete").alias("p"))
    return out.select("id", F.get("p.results", F.lit(0))["id"].alias("first_id"), F.size("p.results").cast("long").alias("n_results"))


@R.query("SELECT n_nationkey, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def first_ancestor(spark, sf_dir):
    """The first named ancestor of a rank."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    entry = lambda rank, name: F.struct(F.lit(rank).alias("rank"), name.alias("name"))
    ancestors = F.array(entry("world", F.lit("")), entry("region", F.lit("")), entry("region", F.col("r_name")), entry("region", F.lit("later")))
    return rows.select("n_nationkey", nested.ancestor(ancestors, "region").alias("region"))


@R.query("""SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN 'not_found' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'http_error'
WHEN l_quantity > 40 THEN 'not_an_image' WHEN l_tax = 0 THEN 'empty_body' ELSE 'ok' END AS outcome FROM lineitem""")
def download_classes(spark, sf_dir):
    status = F.when(F.col("l_returnflag") == "R", 404).when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), 503).otherwise(200)
    kind = F.when(F.col("l_quantity") > 40, "text/html").otherwise("Image/jpeg")
    item = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(item.alias("id"), nested.download_class(status, kind, (F.col("l_tax") * 100).cast("int")).alias("outcome"))


_MIXED = """CASE event_id % 9 WHEN 1 THEN '{"k": "' || user_id || '"}' WHEN 2 THEN '{"k": ' || user_id || '.5}' WHEN 3 THEN '{"k": null}' WHEN 4 THEN '{"k": [' || user_id || ']}'
WHEN 5 THEN '{"other": 1}' WHEN 6 THEN '{"k": true}' WHEN 7 THEN '{"k": {"k": 1}}' WHEN 8 THEN '{"k": ' || user_id ELSE props END"""


@R.query(f"""WITH m AS (SELECT event_id, CASE WHEN json_valid(body) THEN body::JSON END AS j FROM (SELECT event_id, {_MIXED} AS body FROM events))
SELECT event_id, CASE json_type(j, '$.k') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array'
  WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN 'null' END AS kind,
  CASE WHEN json_type(j, '$.k') IN ('UBIGINT', 'BIGINT') THEN (j->>'$.k')::BIGINT END AS whole, CASE WHEN json_type(j, '$.k') = 'VARCHAR' THEN j->>'$.k' END AS words FROM m""")
def guarded_kinds(spark, sf_dir):
    """Properties of mixed kinds, broken ones among them: each is read only as what it is."""
    k = guards.at(F.try_parse_json("body"), "k")
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(_MIXED).alias("body"))
    return rows.select("event_id", guards.kind(k).alias("kind"), guards.read(k, T.LongType()).alias("whole"), guards.read(k, T.StringType()).alias("words"))


@R.query("""SELECT p_partkey AS id, lower(p_name) AS name, p_size AS "count", CASE WHEN p_size % 3 = 0 THEN p_brand END AS common_name FROM part WHERE p_size % 10 NOT BETWEEN 1 AND 8""")
def guarded_summaries(spark, sf_dir):
    """Ranked counts some of whose fields are missing, empty or of another kind: such entries are skipped, never read as something else."""
    text, size = lambda c: F.concat(F.lit('"'), c, F.lit('"')), F.col("p_size").cast("string")
    fault = lambda k, bad, good: F.when(F.col("p_size") % 10 == k, bad).otherwise(good)
    name = fault(1, F.lit("5"), fault(2, F.lit('""'), fault(3, F.lit("null"), text(F.lower("p_name")))))
    taxon = F.concat(F.lit('{"id": '), fault(4, text(size), fault(5, F.lit("0"), F.col("p_partkey").cast("string"))), F.lit(', "name": '), name,
                     F.lit(', "rank": '), fault(6, F.lit('["species"]'), F.lit('"species"')), F.lit(', "preferred_common_name": '), F.when(F.col("p_size") % 3 == 0, text(F.col("p_brand"))).otherwise('""'), F.lit("}"))
    hit = F.concat(F.lit('{"count": '), fault(7, F.concat(size, F.lit(".0")), size), F.lit(', "taxon": '), fault(8, text(size), taxon), F.lit("}"))
    body = table(spark, sf_dir, "part").select(F.concat(F.lit('{"results": ["no hit", 7, null, '), hit, F.lit("]}")).alias("body"))
    hits = body.select(F.explode(nested.project(F.col("body"), "species_counts")["results"]).alias("hit"))
    return hits.select(nested.summary(F.col("hit")).alias("s")).filter("s IS NOT NULL").select("s.id", "s.name", "s.count", "s.common_name")


_DEEP = """'{"k": ' || user_id || ', "meta": {"type": "' || event_type || '"' || CASE WHEN event_id % 5 = 0 THEN ', "added": {"deep": 1}' ELSE '' END
|| '}, "rows": [{"v": 1}, {"v": 2' || CASE WHEN event_id % 7 = 0 THEN ', "w": 3' ELSE '' END || '}]' || CASE WHEN event_id % 11 = 0 THEN ', "extra": null' ELSE '' END || '}'"""


@R.query(rf"""SELECT event_id, t.fullkey || ' is unknown' AS fault FROM (SELECT event_id, ({_DEEP})::JSON AS body FROM events) e, json_tree(e.body) t
WHERE regexp_replace(t.fullkey, '\[\d+\]', '[*]', 'g') NOT IN ('$', '$.k', '$.meta', '$.meta.type', '$.rows', '$.rows[*]', '$.rows[*].v')
AND regexp_replace(t.path, '\[\d+\]', '[*]', 'g') IN ('$', '$.meta', '$.rows', '$.rows[*]')""")
def closed_schema(spark, sf_dir):
    """Every place, at any depth, of a field that a closed schema doesn't know; below an unknown field nothing is listed."""
    closed = T._parse_datatype_string("k long, meta struct<type:string>, rows array<struct<v:int>>")
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(_DEEP).alias("body"))
    return tables.unreadable_places(rows, "body", closed, "event_id")
