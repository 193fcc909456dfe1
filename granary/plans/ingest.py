"""Sources and sinks on the star schema: what a query writes to the shared folder it reads back, and deletes."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import constraints as C
from granary.operators import claims, domain, matcher, nested, store
from granary.plans import matching
from granary.plans.query import Registry
from granary.session import cut, table
from granary.sources import cache, fetching, files, responses, tables

R = Registry()


def _requests(spark, sf_dir):
    """A request for each customer's orders, one customer's the same as another's if they live in one nation and segment."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    params = {"place": F.col("c_nationkey"), "segment": F.col("c_mktsegment")}
    return customers.select(
        cache.cache_key("places_autocomplete", params, 1).alias("key"), F.lit("places_autocomplete").alias("endpoint"),
        F.create_map(F.lit("place"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment")).alias("params"), "c_nationkey", "c_mktsegment",
    )


def _answer(spark, sf_dir):
    """Fetches what a server would answer: the customers of the place and segment as hits."""

    def fetch(missing):
        hits = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(10).alias("admin_level"), F.lit("ignored").alias("extra")))).alias("results"))
        met = missing.join(hits, (F.col("c_nationkey") == F.col("n")) & (F.col("c_mktsegment") == F.col("s")))
        body = F.to_json(F.struct(F.size("results").alias("total_results"), "results"))
        return met.select(*missing.columns, F.lit(200).alias("status"), F.lit("application/json; charset=utf-8").alias("content_type"), F.encode(body, "utf-8").alias("body"))

    return fetch


def _project(body):
    return F.to_json(nested.project(body, "places_autocomplete"))


_TWO_RUNS = """reqs AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)"""


@R.query("SELECT c_nationkey AS place, c_mktsegment AS segment, count(*) AS n, min(c_custkey) AS first_id, max(c_name) AS last_name FROM customer GROUP BY 1, 2")
def read_through_cache(spark, sf_dir):
    """Some requests are answered first, then all are read through the cache: hits and misses give the same rows, projected."""
    path, requests = files.scratch(spark, "cache"), cut(_requests(spark, sf_dir))
    try:
        files.claim_folder(spark, path, "projected-cache", {"projection_version": 1}, ("projection_version",))
        fetching.read_through(requests.filter("c_nationkey < 10"), path, _answer(spark, sf_dir), _project, 1, keep_raw=True)
        entries, _ = fetching.read_through(requests, path, _answer(spark, sf_dir), _project, 1)
        hits = F.from_json("response", f"struct<results:array<{nested.SCHEMAS['places_autocomplete']}>>")["results"]
        rows = entries.select(F.col("params")["place"].cast("int").alias("place"), F.col("params")["segment"].alias("segment"), hits.alias("hits"))
        return cut(rows.select("place", "segment", F.size("hits").cast("long").alias("n"), F.array_min(F.transform("hits", lambda h: h["id"])).alias("first_id"), F.array_max(F.transform("hits", lambda h: h["name"])).alias("last_name")))
    finally:
        files.delete(spark, path)


@R.query(f"""WITH {_TWO_RUNS} SELECT 'places_autocomplete' AS endpoint, count(*) FILTER (c_nationkey < 10) AS hits, count(*) FILTER (c_nationkey >= 10) AS misses,
count(*) || ' requests: ' || count(*) FILTER (c_nationkey < 10) || ' cached, ' || count(*) FILTER (c_nationkey >= 10) || ' fetched (places_autocomplete=' || count(*) FILTER (c_nationkey >= 10) || ')' AS line FROM reqs""")
def request_counters(spark, sf_dir):
    """What a second run costs after a first one asked for some of it."""
    path, requests = files.scratch(spark, "cache"), cut(_requests(spark, sf_dir))
    try:
        fetching.read_through(requests.filter("c_nationkey < 10"), path, _answer(spark, sf_dir), _project, 1)
        _, counters = fetching.read_through(requests, path, _answer(spark, sf_dir), _project, 1)
        return cut(counters.join(fetching.cost_summary(counters)))
    finally:
        files.delete(spark, path)


@R.query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'http_error' WHEN o_orderpriority = '5-LOW' THEN 'not_json' WHEN o_orderkey % 3 = 1 THEN 'undecodable' WHEN o_orderkey % 3 = 2 THEN 'not_an_object' END AS fault FROM orders""")
def response_faults(spark, sf_dir):
    """The first fault of responses: status, kind, decoding, form."""
    status = F.when(F.col("o_orderstatus") == "P", 503).otherwise(200)
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "text/html").otherwise("Application/JSON")
    body = F.when(F.col("o_orderkey") % 3 == 0, '{"a": [1]}').when(F.col("o_orderkey") % 3 == 1, '{"a": [1').otherwise("[1]")
    return table(spark, sf_dir, "orders").select("o_orderkey", fetching.json_fault(status, kind, F.encode(body, "utf-8")).alias("fault"))


@R.query("""SELECT event_id, '{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","days":["' || strftime(ts, '%Y-%m-%d') || '"],"of":{"user":' || user_id || '}}' AS json FROM events""")
def plain_events(spark, sf_dir):
    """Times and dates at any depth as ISO text, so that a value read back equals the one that was written. Times have six digits always."""
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", F.struct(F.col("ts").alias("at"), F.array(F.to_date("ts")).alias("days"), F.struct(F.col("user_id").alias("user")).alias("of")).alias("v"))
    return rows.select("event_id", F.to_json(fetching.plain_json(F.col("v"), rows.schema["v"].dataType, fraction="always")).alias("json"))


@R.query("""SELECT p_partkey, sha256('{"endpoint":"search","key":"' || p_name || '","projection":2}') AS key FROM part""")
def second_source_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", cache.second_key("search", F.col("p_name"), 2).alias("key"))


@R.query("SELECT conv_id, role, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def journal_replay(spark, sf_dir):
    """Rows appended to a journal in several runs; of a key the last line counts, a torn one doesn't."""
    path, rows = files.scratch(spark, "journal"), table(spark, sf_dir, "conversations").select("conv_id", "role", "turn")
    try:
        for run in ("turn < 2", "turn >= 2"):
            cache.append_journal(rows.filter(run), path)
        files.write_small(spark, path, "part-torn.json", '{"conv_id":0,"role":"tor')
        return cut(cache.replay_journal(spark, path, rows.schema, "conv_id", "turn"))
    finally:
        files.delete(spark, path)


@R.query("SELECT reason, count(*) AS n, min(name) AS first_name FROM (SELECT p_name AS name, CASE WHEN p_size > 25 THEN 'too, large' ELSE 'a \"quoted\" reason' END AS reason FROM part) GROUP BY 1")
def ledger_read_back(spark, sf_dir):
    """A drop ledger as CSV with a header, read again by its reasons."""
    path = files.scratch(spark, "ledger")
    try:
        reason = F.when(F.col("p_size") > 25, "too, large").otherwise('a "quoted" reason')
        tables.write_ledger(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), reason.alias("reason")), path, "name")
        return cut(tables.read_ledger(spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first_name")))
    finally:
        files.delete(spark, path)


_NESTED = "c_custkey bigint, orders array<struct<o_orderkey:bigint,o_orderstatus:string>>"


@R.query("SELECT o_custkey AS c_custkey, count(*) AS n, string_agg(o_orderstatus, '' ORDER BY o_orderkey) AS statuses FROM orders GROUP BY 1")
def pool_read_back(spark, sf_dir):
    """A stage's nested JSON, committed in one move; its journal is retired then. The next stage reads it under the stage's schema."""
    path, journal = files.scratch(spark, "pool"), files.scratch(spark, "journal")
    try:
        orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.struct("o_orderkey", "o_orderstatus").alias("o"))
        cache.append_journal(orders.select("c_custkey").distinct(), journal)
        files.commit(orders.groupBy("c_custkey").agg(F.array_sort(F.collect_list("o")).alias("orders")), path, retire=journal)
        if files.exists(spark, journal):
            raise AssertionError("the journal outlived the commit")
        pool = tables.read_nested(spark, path, _NESTED)
        return cut(pool.select("c_custkey", F.size("orders").cast("long").alias("n"), F.array_join(F.transform("orders", lambda x: x["o_orderstatus"]), "").alias("statuses")))
    finally:
        files.delete(spark, path)


@R.query("SELECT sha256(text) AS sha256, left(sha256(text), 2) AS shard FROM documents WHERE lang <> 'de' GROUP BY 1, 2")
def store_collected(spark, sf_dir):
    """A store filled in two runs that overlap, then cleared of what nothing refers to."""
    path, docs = files.scratch(spark, "store"), table(spark, sf_dir, "documents")
    try:
        files.claim_folder(spark, path, "store", domain.Profile(500, 75, "WEBP", "codec 1")._asdict())
        for run in ("doc_id % 3 < 2", "doc_id % 3 > 0"):
            store.write_contents(store.addressed(docs.filter(run).select("text"), "text"), path)
        wanted = docs.filter("lang <> 'de'").select(F.sha2("text", 256).alias("sha256")).distinct()
        store.collect(spark, path, wanted, dry_run=False)
        return cut(spark.read.parquet(path).select("sha256", "shard"))
    finally:
        files.delete(spark, path)


@R.query("SELECT count(DISTINCT lang) AS files, count(*) AS n_rows, 0::BIGINT AS none FROM documents")
def store_size(spark, sf_dir):
    """Files and rows below a path; a path that isn't there holds nothing."""
    path = files.scratch(spark, "sized")
    try:
        table(spark, sf_dir, "documents").select("doc_id", "lang").repartition(1).write.partitionBy("lang").json(path)
        data = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
        sized = tables.directory_size(spark, path).select(F.col("bytes").alias("all_bytes"))
        found = data.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).join(sized)
        rows = spark.read.schema("doc_id long").json(path).agg(F.count(F.lit(1)).alias("n_rows"))
        none = tables.directory_size(spark, path + "-none").select((F.col("files") + F.col("bytes")).alias("none"))
        return cut(found.filter("bytes <= all_bytes").select("files").join(rows).join(none))
    finally:
        files.delete(spark, path)


@R.query("""SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN c_nationkey * 100 + 7 END AS place_id FROM customer""")
def state_places(spark, sf_dir):
    """The first hit of the right level, country and name among decoys; null if there is none."""
    hit = lambda i, name, level, country: F.struct(i.cast("long").alias("id"), name.alias("name"), F.lit(level).alias("admin_level"), F.array(F.lit(country).cast("long")).alias("ancestor_place_ids"))
    base, name = F.col("c_nationkey") * 100, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    right = F.when(F.col("c_nationkey") < 20, name).otherwise(F.concat(name, F.lit("x")))
    hits = F.array(hit(base + 1, name, 100, 1), hit(base + 2, name, 10, 2), hit(base + 7, right, 10, 1), hit(base + 8, right, 10, 1))
    return table(spark, sf_dir, "customer").select("c_custkey", nested.state_place(hits, name).alias("place_id"))


@R.query("SELECT doc_id, CASE WHEN quality = 1 THEN 'native' WHEN quality = 0 THEN 'introduced' END AS value FROM documents LEFT JOIN labels USING (doc_id)")
def domain_answers(spark, sf_dir):
    """The domain's claim for every id, null where none was made; values are of its vocabulary."""
    plants = domain.resolve_domain("plants")
    words = domain.options(spark, plants)
    value = F.when(F.col("quality") == 1, "native").otherwise("introduced")
    claims = table(spark, sf_dir, "labels").select("doc_id", F.struct(value.alias("value")).alias("claim"))
    known = claims.join(F.broadcast(words), F.col("claim.value") == F.col("value"), "left_semi")
    return domain.answers(table(spark, sf_dir, "documents").select("doc_id"), known, "doc_id").select("doc_id", "claim.value")


@R.query("""SELECT o_orderkey, 'retrieved ' || strftime(o_orderdate, '%Y-%m-%d') AS version, 'Michigan checklist retrieved ' || strftime(o_orderdate, '%Y-%m-%d') AS checklist, 'codec 1/WEBP/75/500' AS encoder, 3::INT AS n_sources FROM orders""")
def source_references(spark, sf_dir):
    """Provenance: sources without editions are versioned by the day they were read."""
    at = F.col("o_orderdate").cast("timestamp")
    first = domain.retrieved_ref("records", "https://records", at)
    second = domain.checklist_ref("checklist", "https://places", F.lit("Michigan"), at)
    profile = domain.Profile(500, 75, "WEBP", "codec 1")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", first.alias("a"), second.alias("b"), domain.produced_by(F.array(first), profile, "s3://bucket", at).alias("all"))
    return rows.select("o_orderkey", F.col("a.version").alias("version"), F.col("b.version").alias("checklist"), F.element_at("all", -1)["version"].alias("encoder"), F.size("all").alias("n_sources"))


@R.query("SELECT p_partkey, string_split(p_name, ' ')[1] AS genus_hint, CASE WHEN p_size % 2 = 0 THEN 'Plantae' ELSE 'Aves' END AS slug FROM part")
def name_hints(spark, sf_dir):
    slug = X.iconic_slug(F.when(F.col("p_size") % 2 == 0, 47126).otherwise(3))
    return table(spark, sf_dir, "part").select("p_partkey", X.genus_hint(F.concat(F.lit(" "), "p_name")).alias("genus_hint"), slug.alias("slug"))


@R.query("""SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_name END AS binomial, p_type IN ('LARGE', 'SMALL') AS is_infraspecific FROM part""")
def parsed_names(spark, sf_dir):
    """First italic block, across lines, with single spaces; markers count wherever they stand outside tags."""
    name = F.concat(F.lit("<i>"), F.replace("p_name", F.lit(" "), F.lit("\n ")), F.lit("</i> L."))
    html = F.when(F.col("p_size") % 3 != 0, name).otherwise(F.lit("no block"))
    marker = F.when(F.col("p_type") == "LARGE", F.lit(" <b>SSP.</b> x")).when(F.col("p_type") == "SMALL", F.lit(" nothovar. y")).otherwise(F.lit(" overvar. z"))
    parsed = X.parse_name(F.concat(html, marker))
    return table(spark, sf_dir, "part").select("p_partkey", parsed.alias("n")).select("p_partkey", "n.binomial", "n.is_infraspecific")


@R.query("""SELECT 'wrong_owner' AS "constraint", o_orderkey::VARCHAR AS key FROM orders WHERE o_custkey % 100 <> o_custkey % 1000
UNION ALL SELECT 'stale_count', o_orderkey::VARCHAR FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) WHERE n <> 4
UNION ALL SELECT DISTINCT 'pack_version', p_size::VARCHAR FROM part WHERE p_size <> 7 AND p_size > 45""")
def owned_and_recomputed(spark, sf_dir):
    """Children filed under another parent, signals that differ from what the children give, and versions that aren't this build's."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    filed = orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("own"), (F.col("o_custkey") % 1000).alias("filed"))
    header = table(spark, sf_dir, "part").filter("p_size > 45").select("p_size").distinct()
    return C.all_of(
        C.belongs(filed, "own", "filed", "o_orderkey", "wrong_owner"),
        C.recomputed(orders.select("o_orderkey", F.lit(4).cast("long").alias("n")), "o_orderkey", lines, "l_orderkey", {"n": F.count(F.lit(1))}, "stale_count"),
        C.version_is(header, "p_size", 7, "pack_version"),
    )


@R.query("""SELECT DISTINCT 'no_full_answer' AS "constraint", min(p_partkey)::VARCHAR AS key FROM part WHERE p_name LIKE 'red %' GROUP BY p_name""")
def deck_faults(spark, sf_dir):
    """Cards without any accepted answer; cards asked by genus never grant partial credit."""
    cards = matching.cards(spark, sf_dir)
    nameless = F.col("scientific_name").startswith("red ")
    blank = cards.withColumn("scientific_name", F.when(nameless, "...").otherwise(F.col("scientific_name")))
    return matcher.deck_violations(blank, matcher.build_deck(blank))


@R.query("SELECT n_regionkey AS state, count(*) AS n FROM nation GROUP BY 1 HAVING count(*) <= 15")
def policy_entries(spark, sf_dir):
    """A committed policy list, read under its cap per state."""
    path = files.scratch(spark, "policy")
    try:
        entries = F.collect_list(F.struct(F.col("n_regionkey").alias("state"), F.col("n_nationkey").alias("id")))
        table(spark, sf_dir, "nation").agg(F.to_json(entries).alias("value")).write.text(path)
        return cut(tables.read_policy(spark, path, "state int, id int", "state").groupBy("state").agg(F.count(F.lit(1)).alias("n")))
    finally:
        files.delete(spark, path)


@R.query("""WITH r AS (SELECT p_partkey AS id, (row_number() OVER (ORDER BY p_partkey) - 1) // 30 AS batch FROM (SELECT DISTINCT p_partkey FROM part WHERE p_size <> 11))
SELECT batch, count(*) AS n, sha256('{"endpoint":"taxa_by_id","params":{"ids":[' || string_agg(id, ',' ORDER BY id) || ']},"projection_version":1}') AS cache_key FROM r GROUP BY 1""")
def batched_requests(spark, sf_dir):
    """Details are asked for thirty ids at a time: each batch's size and the key of its request."""
    batches = fetching.request_batches(table(spark, sf_dir, "part").filter("p_size <> 11"), "p_partkey")
    return batches.select("batch", F.size("ids").cast("long").alias("n"), cache.cache_key("taxa_by_id", {"ids": F.col("ids")}, 1).alias("cache_key"))


@R.query("""WITH b AS (SELECT p_partkey AS id, p_size AS s, (row_number() OVER (ORDER BY p_partkey) - 1) // 30 AS batch FROM part), answers AS (
  SELECT id, batch, CASE WHEN id % 4 = 0 THEN 'late' ELSE 'early' END AS name FROM b WHERE s % 9 <> 0)
SELECT b.id, b.batch, coalesce(a.name, 'absent') AS answer FROM b LEFT JOIN answers a USING (id)""")
def batched_answers(spark, sf_dir):
    """Answers to batches of ids exploded back to the ids: the last answer of an id counts, some of them come with another batch, and some ids get none."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    batches = cut(fetching.request_batches(part, "p_partkey"))
    asked = batches.select("batch", F.explode("ids").alias("id"))
    sizes = asked.join(part, F.col("id") == F.col("p_partkey")).filter("p_size % 9 <> 0")
    entry = lambda name: F.struct("id", F.lit(name).alias("name"))
    body = lambda rows, batch, name: rows.groupBy(batch.alias("batch")).agg(F.collect_list(entry(name)).alias("results"))
    early, late = body(sizes, F.col("batch"), "early"), body(sizes.filter("id % 4 = 0"), F.col("batch") + 1, "late")
    both = early.union(late).select(F.col("batch").alias("ord"), F.to_json(F.struct("results")).alias("response"))
    hits = both.select("ord", F.posexplode(nested.project(F.col("response"), "taxa_by_id")["results"]).alias("place", "t")).select(F.struct("ord", "place").alias("ord"), F.col("t.id").alias("of"), F.col("t.name").alias("name"))
    # an id's late answer came in a later response, whichever batch that answers
    last = claims.last_wins(hits, ["of"], "ord")
    return asked.join(last, F.col("id") == F.col("of"), "left").select("id", "batch", F.coalesce("name", F.lit("absent")).alias("answer"))


_REPORT = """'{"agreement": ' || CASE WHEN event_id % 3 = 0 THEN '"many"' ELSE CAST(user_id AS STRING) END || ', "by_tier": {"1": ' || user_id || ', "2": "two", "3": ' || (user_id + 1) || '.5}'
|| ', "conflicts": [{"name": "' || event_type || '", "first": "a", "second": "b"}, {"name": 7, "first": "a", "second": "b"}, "junk", {"name": "x", "first": "a"}]' || CASE WHEN event_id % 5 = 0 THEN ', "single_source": 5' ELSE
', "single_source": [{"name": "n", "source": "first", "value": "' || user_id || '"}, null]' END || ', "excluded": ["' || event_type || '", 3, null]}'"""


@R.query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS agreement, 0::BIGINT AS no_source, '1=' || user_id AS by_tier, event_type || ':a:b' AS conflicts,
CASE WHEN event_id % 5 = 0 THEN '' ELSE 'n:first:' || user_id END AS single_source, event_type AS excluded FROM events""")
def reread_reports(spark, sf_dir):
    """Reports with malformed entries read again: what can be read stays, the rest is left out."""
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(_REPORT).alias("body"))
    found = tables.read_report(rows, "body", "event_id")
    triple = lambda c, *names: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[n] for n in names])), ",").alias(c)
    tiers = F.array_join(F.transform(F.map_entries("by_tier"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("by_tier")
    return found.select("event_id", "agreement", "no_source", tiers, triple("conflicts", "name", "first", "second"), triple("single_source", "name", "source", "value"), F.array_join("excluded", ",").alias("excluded"))


@R.query("""SELECT DISTINCT c_nationkey || ':' || c_mktsegment AS key, 1 + c_nationkey % 2 AS projection_version, c_mktsegment AS segment FROM customer WHERE c_nationkey % 3 = 1 AND c_nationkey % 2 = 0""")
def response_source(spark, sf_dir):
    """Responses written and read again through their data source, which opens one endpoint's files and hands on one version's entries."""
    responses.register(spark)
    path = files.scratch(spark, "responses")
    asked = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    endpoint = F.element_at(F.array(*[F.lit(x) for x in ("observations", "taxa_by_id", "species_counts")]), F.col("c_nationkey").cast("int") % 3 + 1)
    rows = asked.select(
        F.concat_ws(":", "c_nationkey", "c_mktsegment").alias("key"), endpoint.alias("endpoint"), F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("params"),
        (1 + F.col("c_nationkey") % 2).cast("int").alias("projection_version"), F.lit("2026-01-01").alias("fetched_at"), F.lit("{}").alias("response"),
    )
    try:
        rows.write.format(responses.NAME).mode("append").save(path)
        found = spark.read.format(responses.NAME).load(path).filter("endpoint = 'taxa_by_id' AND projection_version = 1")
        return cut(found.select("key", "projection_version", F.col("params")["segment"].alias("segment")))
    finally:
        files.delete(spark, path)
