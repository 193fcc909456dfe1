"""The curation pipeline on the star schema: parts are taxa, their lineitems observations with two photos each.

Every query runs the pipeline of granary.plans.pool up to its stage, over all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import ledger, nested, promote
from granary.plans import pool as P
from granary.plans.query import Registry
from granary.sources import tables
from granary.session import cut, table

R = Registry()
#: Taxa wanted in the pool; half as many again are considered and may be lost.
LIMIT = 120
PLACE = 29


def _name():
    return F.when(F.col("p_size") == 7, F.replace("p_name", F.lit(" "), F.lit(" x "))).otherwise(F.concat_ws(" ", "p_name", "p_brand"))


def _summaries(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg((2 * F.count(F.lit(1))).alias("count"))
    parts = table(spark, sf_dir, "part").join(lines, F.col("p_partkey") == F.col("l_partkey"))
    rank = F.when(F.col("p_type") == "PROMO", "genus").otherwise("species")
    order = -F.col("count") * F.lit(1 << 32) + F.col("p_partkey")
    return parts.select(order.alias("ord"), F.col("p_partkey").alias("id"), _name().alias("name"), rank.alias("rank"), "count")


def _details(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_size <> 11")
    return parts.select(F.col("p_partkey").alias("id"), F.split("p_name", " ")[0].alias("genus"), F.col("p_brand").alias("family"))


def _observations(spark, sf_dir):
    from granary.operators.sampling import month_bucket

    item = F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber") * 100_000 + F.col("l_partkey") % 100_000
    url = lambda i: F.format_string("https://h/photos/%d/square.jpg", i)
    first = F.when(F.col("l_returnflag") == "A", "CC0").when(F.col("l_returnflag") == "N", "cc-by").otherwise("cc-by-nc")
    second = F.when(F.col("l_linestatus") == "O", "CC-BY-SA")
    photo = lambda i, code: F.struct(i.alias("id"), code.alias("license_code"), url(i).alias("url"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("taxon_id"), month_bucket(F.col("l_shipdate")).alias("bucket"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("ord"), item.alias("id"),
        (F.col("l_quantity") - 25).cast("int").alias("num_identification_agreements"), F.struct(F.concat(F.lit("u"), "l_suppkey").alias("login"), F.lit("").alias("name")).alias("user"),
        F.array(photo(item * 10, first), photo(item * 10 + 1, second)).alias("photos"),
    )


def _pool(spark, sf_dir):
    return P.candidate_pool(_summaries(spark, sf_dir), _details(spark, sf_dir), _observations(spark, sf_dir), LIMIT)


_BUCKET = "CASE WHEN month(l_shipdate) BETWEEN 3 AND 5 THEN 'A' WHEN month(l_shipdate) IN (6, 7) THEN 'B' WHEN month(l_shipdate) IN (8, 9) THEN 'C' ELSE 'D' END"
_STAGES = f"""summ AS (SELECT p_partkey AS id, CASE WHEN p_size = 7 THEN replace(p_name, ' ', ' x ') ELSE p_name || ' ' || p_brand END AS name,
    CASE WHEN p_type = 'PROMO' THEN 'genus' ELSE 'species' END AS rank, 2 * n AS cnt, p_size, p_brand, string_split(p_name, ' ')[1] AS genus
  FROM part JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON p_partkey = l_partkey),
one AS (SELECT *, CASE WHEN name LIKE '% x %' THEN 'hybrid' WHEN rank <> 'species' THEN 'not_species_rank' WHEN cnt < 50 THEN 'below_observation_floor' END AS reason FROM summ),
first AS (SELECT *, coalesce(sum((reason IS NULL)::INT) OVER (ORDER BY cnt DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM one QUALIFY ahead < {2 * LIMIT}),
found AS (SELECT * FROM first WHERE reason IS NULL AND p_size <> 11),
seen AS (SELECT l_partkey AS t, l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey % 100000 AS i, {_BUCKET} AS b, 'u' || l_suppkey AS o, round(l_extendedprice * 100)::BIGINT AS ord,
    greatest((l_quantity - 25)::INT, 0) AS agreements, l_returnflag AS rf, l_suppkey, l_quantity,
    CASE WHEN l_returnflag <> 'R' THEN 0 ELSE 1 END AS second, CASE l_returnflag WHEN 'A' THEN 'cc0' WHEN 'N' THEN 'cc-by' ELSE 'cc-by-sa' END AS license
  FROM lineitem WHERE (l_returnflag <> 'R' OR l_linestatus = 'O') AND l_partkey IN (SELECT id FROM found)
  QUALIFY row_number() OVER (PARTITION BY t, i ORDER BY b, ord) = 1),
g AS (SELECT t, list({{'i': i, 'b': b, 'o': o}} ORDER BY i) AS a FROM seen GROUP BY 1),
f(t, a, k, acc) AS (
  SELECT t, a, 0, a[1:0] FROM g
  UNION ALL
  SELECT t, a, k + 1, CASE WHEN len(acc) >= 8 THEN acc ELSE list_concat(acc, list_filter(a, lambda x: x.b = ['A', 'B', 'C', 'D'][k % 4 + 1]
    AND len(list_filter(acc, lambda y: y.i = x.i)) = 0 AND len(list_filter(acc, lambda y: y.o = x.o)) < 2)[1:1]) END FROM f WHERE k < 32),
picked AS (SELECT t, acc FROM f WHERE k = 32),
two AS (SELECT found.* EXCLUDE (ahead, reason), coalesce(len(acc), 0) AS n_photos, CASE WHEN coalesce(len(acc), 0) < 4 THEN 'insufficient_licensed_photos' END AS reason FROM found LEFT JOIN picked ON id = t),
last AS (SELECT *, coalesce(sum((reason IS NULL)::INT) OVER (ORDER BY cnt DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM two QUALIFY ahead < {LIMIT}),
taxa AS (SELECT * FROM last WHERE reason IS NULL),
drops AS (SELECT id, name, reason, name || ': rank ' || rank || ', ' || cnt || ' observations' AS detail FROM first WHERE reason IS NOT NULL
  UNION ALL SELECT id, name, 'taxon_detail_unavailable', 'no detail was returned' FROM first WHERE reason IS NULL AND p_size = 11
  UNION ALL SELECT id, name, reason, n_photos || ' usable photos' FROM last WHERE reason IS NOT NULL),
chosen AS (SELECT t, unnest(range(len(acc))) AS place, unnest(acc) AS c FROM picked WHERE t IN (SELECT id FROM taxa)),
photos AS (SELECT c.t, place::INT AS place, s.b, s.i, s.o, s.agreements, s.i * 10 + s.second AS photo_id, s.license, s.l_suppkey, s.l_quantity FROM chosen c JOIN seen s ON c.t = s.t AND c.c.i = s.i),
signals AS (SELECT t, count(DISTINCT b) AS months, count(DISTINCT o) AS observers FROM photos GROUP BY 1)"""
_WITH = f"WITH RECURSIVE {_STAGES}"


@R.query(f"{_WITH} SELECT id, name, reason, detail FROM drops WHERE reason IN ('hybrid', 'not_species_rank', 'below_observation_floor')")
def taxa_rejected(spark, sf_dir):
    """The first stage's ledger, every drop with its values."""
    return P.select_taxa(_summaries(spark, sf_dir), 2 * LIMIT)[1]


@R.query(f"{_WITH} SELECT id, name, genus, p_brand AS family, cnt AS \"count\", n_photos, months AS months_represented, observers AS distinct_observers FROM taxa JOIN signals ON id = t")
def pool_taxa(spark, sf_dir):
    return _pool(spark, sf_dir).taxa.select("id", "name", "genus", "family", "count", F.col("n_photos").cast("long"), "months_represented", "distinct_observers")


@R.query(f"{_WITH} SELECT t AS taxon_id, place, b AS bucket, i AS observation_id, o AS observer, agreements, photo_id, license FROM photos")
def pool_photos(spark, sf_dir):
    photos = _pool(spark, sf_dir).photos
    return photos.select("taxon_id", F.col("place").cast("int").alias("place"), "bucket", "observation_id", "observer", "agreements", F.col("photo.id").alias("photo_id"), F.col("photo.license_code").alias("license"))


@R.query(f"{_WITH} SELECT id, name, reason, detail FROM drops")
def pool_drops(spark, sf_dir):
    return _pool(spark, sf_dir).drops


@R.query(f"""{_WITH} SELECT 'repeated_observation' AS "constraint", i::VARCHAR AS key FROM photos GROUP BY i HAVING count(*) > 1""")
def pool_integrity(spark, sf_dir):
    """All broken constraints of the pool, recomputed signals among them."""
    return P.pool_violations(_pool(spark, sf_dir))


_FAULTY = """twice AS (SELECT id FROM taxa UNION ALL SELECT id FROM taxa WHERE id % 7 = 0),
lost AS (SELECT id FROM drops UNION ALL SELECT id FROM drops WHERE id % 11 = 0 UNION ALL SELECT id FROM taxa WHERE id % 5 = 0),
shots AS (SELECT CASE WHEN t % 13 = 0 THEN -t ELSE t END AS t, CASE WHEN t % 17 = 0 THEN 'one' ELSE o END AS o, b, i FROM photos WHERE t % 6 <> 0 OR place < 2 UNION ALL SELECT t, o, b, i FROM photos WHERE t % 19 = 0 AND place = 0),
seen_now AS (SELECT t, count(*) AS n, count(DISTINCT b) AS months, count(DISTINCT o) AS observers FROM shots GROUP BY 1),
stored AS (SELECT id, n_photos, months, observers FROM taxa JOIN signals ON id = t UNION ALL SELECT id, n_photos, months, observers FROM taxa JOIN signals ON id = t WHERE id % 7 = 0)"""


@R.query(f"""{_WITH}, {_FAULTY}
SELECT 'duplicate_taxon' AS "constraint", id::VARCHAR AS key FROM twice GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'duplicate_drop', id::VARCHAR FROM lost GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'kept_and_dropped', id::VARCHAR FROM (SELECT id FROM twice INTERSECT SELECT id FROM lost)
UNION ALL SELECT DISTINCT 'photo_of_no_taxon', t::VARCHAR FROM shots WHERE t NOT IN (SELECT id FROM twice) UNION ALL SELECT 'repeated_observation', i::VARCHAR FROM shots GROUP BY i HAVING count(*) > 1
UNION ALL SELECT 'photo_count', t::VARCHAR FROM shots GROUP BY t HAVING count(*) NOT BETWEEN 4 AND 8 UNION ALL SELECT 'observer_cap', t::VARCHAR FROM shots GROUP BY t, o HAVING count(*) > 2
UNION ALL SELECT 'stale_signals', id::VARCHAR FROM stored s LEFT JOIN seen_now n ON id = t WHERE n_photos <> coalesce(n, 0) OR s.months <> coalesce(n.months, 0) OR s.observers <> coalesce(n.observers, 0)""")
def pool_faults(spark, sf_dir):
    """A pool with faults of every kind put into it, and all constraints it breaks."""
    pool = _pool(spark, sf_dir)
    photos = pool.photos.withColumn("observer", F.when(F.col("taxon_id") % 17 == 0, "one").otherwise(F.col("observer")))
    kept = photos.filter("taxon_id % 6 <> 0 OR place < 2").withColumn("taxon_id", F.when(F.col("taxon_id") % 13 == 0, -F.col("taxon_id")).otherwise(F.col("taxon_id")))
    shots = cut(kept.unionByName(pool.photos.filter("taxon_id % 19 = 0 AND place = 0")))
    lost = pool.drops.select("id").union(pool.drops.filter("id % 11 = 0").select("id")).union(pool.taxa.filter("id % 5 = 0").select("id"))
    return P.pool_violations(P.Pool(cut(pool.taxa.union(pool.taxa.filter("id % 7 = 0"))), shots, lost))


@R.query(f"{_WITH} SELECT (SELECT count(*) FROM taxa) AS kept, (SELECT count(*) FROM drops) AS dropped, (SELECT count(*) FROM taxa) + (SELECT count(*) FROM drops) AS considered")
def pool_considered(spark, sf_dir):
    pool = _pool(spark, sf_dir)
    return P.considered(pool.taxa, pool.drops)


def _statistics(found: dict, *names: str):
    """Some of a stage's statistics as rows: section, key, n."""
    rows = None
    for name in names:
        df = found[name]
        keys, values = [c for c, kind in df.dtypes if kind == "string"], [c for c, kind in df.dtypes if kind != "string" and c != "share_pct"]
        for v in values:
            part = df.select(F.lit(name).alias("section"), (F.col(keys[0]) if keys else F.lit(v)).alias("key"), F.col(v).cast("long").alias("n"))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def _distribution_sql(section: str, rows: str, value: str) -> str:
    return f"""SELECT '{section}', 'median', (SELECT trunc(median({value}))::BIGINT FROM {rows}) UNION ALL
  SELECT '{section}', 'p10', (SELECT (list_sort(list({value}))[1 + round_even(0.1 * (count(*) - 1), 0)::BIGINT])::BIGINT FROM {rows})"""


@R.query(f"""{_WITH}, depth AS (SELECT t, count(*) AS n FROM photos GROUP BY 1), sized AS (SELECT taxa.*, months, observers FROM taxa JOIN signals ON id = t)
SELECT 'reasons' AS section, v.reason AS key, count(d.id) AS n FROM (SELECT unnest({list(P.CANDIDATE_REASONS)}) AS reason) v LEFT JOIN drops d USING (reason) GROUP BY 2
UNION ALL SELECT 'licenses', license, count(*) FROM photos GROUP BY 2
UNION ALL SELECT 'buckets', v.b, count(p.i) FROM (SELECT unnest(['A', 'B', 'C', 'D']) AS b) v LEFT JOIN photos p USING (b) GROUP BY 2
UNION ALL SELECT 'thin_rich', 'thin', count(*) FILTER (n <= 5) FROM depth UNION ALL SELECT 'thin_rich', 'rich', count(*) FILTER (n > 5) FROM depth
UNION ALL {_distribution_sql('observations', 'sized', 'cnt')} UNION ALL {_distribution_sql('months', 'sized', 'months')} UNION ALL {_distribution_sql('observers', 'sized', 'observers')}""")
def pool_summary(spark, sf_dir):
    """The statistics of the pool: zero-filled reasons and buckets, licences, depth and distributions."""
    return _statistics(P.pool_statistics(_pool(spark, sf_dir)), "reasons", "licenses", "buckets", "thin_rich", "observations", "months", "observers")


def _fetch(spark, sf_dir):
    """Answers to the photos' addresses: some are gone, some are no images, some empty; equal numbers give equal bytes."""

    def fetch(asked):
        photo = F.regexp_extract("url", r"/photos/(\d+)/", 1).cast("long")
        rows = asked.withColumn("photo", photo)
        status = F.when(F.col("photo") % 17 == 0, 404).when(F.col("photo") % 19 == 0, 503).otherwise(200)
        kind = F.when(F.col("photo") % 13 == 0, "text/html").otherwise("image/jpeg")
        content = F.when(F.col("photo") % 23 == 0, F.lit(b"")).otherwise(F.encode(F.concat(F.lit("c"), (F.col("photo") % 37).cast("string")), "utf-8"))
        return rows.select("url", status.alias("status"), kind.alias("content_type"), content.alias("content"))

    return fetch


def _resolved(spark, sf_dir, pool=None):
    pool = pool or _pool(spark, sf_dir)
    photos = pool.photos.select("taxon_id", F.col("photo.id").alias("photo_id"))
    # an earlier run settled some taxa; the store has some contents besides
    settled = photos.filter("taxon_id % 5 = 0").select("taxon_id", "photo_id", F.sha2(F.concat(F.lit("s"), F.col("photo_id").cast("string")), 256).alias("sha256"), F.lit(None).cast("string").alias("reason"))
    known = photos.filter("photo_id % 29 = 0").select("photo_id", F.sha2(F.concat(F.lit("k"), F.col("photo_id").cast("string")), 256).alias("sha256"))
    return pool, *P.resolve_pool(pool, _fetch(spark, sf_dir), settled, known)


_RESOLVED = """asked AS (SELECT t, place, b, o, photo_id, photo_id % 29 = 0 AS known FROM photos WHERE t % 5 <> 0),
answered AS (SELECT *, CASE WHEN known THEN NULL WHEN photo_id % 17 = 0 THEN 'not_found' WHEN photo_id % 19 = 0 THEN 'http_error' WHEN photo_id % 13 = 0 THEN 'not_an_image' WHEN photo_id % 23 = 0 THEN 'empty_body' END AS fault,
  sha256(CASE WHEN known THEN 'k' || photo_id ELSE 'c' || photo_id % 37 END) AS h FROM asked),
unique_ones AS (SELECT *, CASE WHEN fault IS NOT NULL THEN fault WHEN row_number() OVER (PARTITION BY t, h, fault IS NULL ORDER BY place) > 1 THEN 'duplicate_content' END AS why FROM answered),
thin AS (SELECT t FROM unique_ones GROUP BY 1 HAVING count(*) FILTER (why IS NULL) < 4),
resolved AS (SELECT t, place, b, o, photo_id, h FROM unique_ones WHERE why IS NULL AND t NOT IN (SELECT t FROM thin)
  UNION ALL SELECT t, place, b, o, photo_id, sha256('s' || photo_id) FROM photos WHERE t % 5 = 0),
lost AS (SELECT t, photo_id, why AS reason FROM unique_ones WHERE why IS NOT NULL UNION ALL SELECT t, NULL, 'insufficient_resolved_photos' FROM thin)"""


@R.query(f"{_WITH}, {_RESOLVED} SELECT t AS taxon_id, place, b AS bucket, o AS observer, photo_id, h AS sha256 FROM resolved")
def resolved_photos(spark, sf_dir):
    """Photos against fetched bytes, the ledger of an earlier run and the store."""
    return _resolved(spark, sf_dir)[1].withColumn("place", F.col("place").cast("int"))


@R.query(f"{_WITH}, {_RESOLVED} SELECT t AS taxon_id, photo_id, reason FROM lost")
def resolve_drops(spark, sf_dir):
    return _resolved(spark, sf_dir)[2]


@R.query(f"""{_WITH}, {_RESOLVED} SELECT (SELECT count(*) FROM resolved) AS stored, (SELECT count(DISTINCT h) FROM resolved) AS distinct_contents, (SELECT count(DISTINCT t) FROM photos WHERE t % 5 = 0) AS taxa_reused,
(SELECT count(DISTINCT photo_id) FROM asked WHERE NOT known) AS fetched, (SELECT count(photo_id) FROM lost) AS failures, (SELECT count(*) FROM lost WHERE reason = 'duplicate_content') AS deduped""")
def resolve_counters(spark, sf_dir):
    return _resolved(spark, sf_dir)[3]


@R.query(f"""{_WITH}, {_RESOLVED}, sizes AS (SELECT *, 10 + photo_id % 91 AS bytes FROM resolved), per AS (SELECT t, count(DISTINCT b) AS months, count(DISTINCT o) AS observers FROM resolved GROUP BY 1)
SELECT 'images' AS section, 'taxa' AS key, count(DISTINCT t) AS n FROM resolved UNION ALL SELECT 'images', 'images', count(*) FROM resolved UNION ALL SELECT 'images', 'distinct_contents', count(DISTINCT h) FROM resolved
UNION ALL SELECT 'losses', v.reason, count(l.t) FROM (SELECT unnest({list(P.RESOLVE_REASONS)}) AS reason) v LEFT JOIN lost l USING (reason) GROUP BY 2
UNION ALL {_distribution_sql('months', 'per', 'months')} UNION ALL {_distribution_sql('observers', 'per', 'observers')}""")
def resolved_summary(spark, sf_dir):
    _, resolved, drops, _ = _resolved(spark, sf_dir)
    sizes = resolved.select("sha256", F.length("sha256").alias("bytes")).distinct()
    return _statistics(P.resolved_statistics(resolved, drops, sizes), "images", "losses", "months", "observers")


def _records(spark, sf_dir):
    """The second source's records: parts by another spelling, some infraspecific, some synonyms."""
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", "p_brand")
    spelled = F.when(F.col("p_size") % 3 == 0, F.upper(name)).otherwise(name)
    accepted = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("S"), (F.col("p_partkey") - F.col("p_partkey") % 10).cast("string"))).otherwise(F.lit(""))
    symbol = F.concat(F.lit("S"), F.col("p_partkey").cast("string"))
    return part.select(symbol.alias("symbol"), spelled.alias("binomial"), (F.col("p_type") == "LARGE").alias("is_infraspecific"), accepted.alias("accepted_symbol"), (F.col("p_size") % 4 == 0).alias("is_synonym"))


def _statuses(spark, sf_dir):
    """Each part's status, given twice for some: the last one counts."""
    part = table(spark, sf_dir, "part").filter("p_size <> 50")
    symbol = F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("symbol")
    code = F.when(F.col("p_size") % 10 < 6, "N").when(F.col("p_size") % 10 < 8, "I").when(F.col("p_size") % 10 == 8, "N?").otherwise("NI")
    early = part.filter("p_size % 2 = 0").select(symbol, F.lit("L48").alias("region"), F.lit("I").alias("status"), F.lit(0).alias("pos"))
    late = part.select(symbol, F.lit("L48").alias("region"), code.alias("status"), F.lit(1).alias("pos"))
    return early.union(late).union(part.select(symbol, F.lit("AK").alias("region"), F.lit("I").alias("status"), F.lit(2).alias("pos")))


def _reconciled(spark, sf_dir, pool=None):
    taxa = (pool or _pool(spark, sf_dir)).taxa
    return taxa, P.reconcile(taxa.select("id", "name"), _records(spark, sf_dir), _statuses(spark, sf_dir))


_RECONCILED = """records AS (SELECT p_partkey AS symbol, CASE WHEN p_size % 3 = 0 THEN upper(p_name || ' ' || p_brand) ELSE p_name || ' ' || p_brand END AS binomial, p_size % 4 = 0 AS is_synonym,
    CASE WHEN p_size % 4 = 0 THEN p_partkey - p_partkey % 10 ELSE p_partkey END AS target FROM part WHERE p_type <> 'LARGE'),
met AS (SELECT t.id, r.target, CASE WHEN t.name = r.binomial AND NOT is_synonym THEN 1 WHEN t.name = r.binomial THEN 2 ELSE 3 END AS tier FROM taxa t JOIN records r ON lower(t.name) = lower(r.binomial)),
best AS (SELECT DISTINCT id, tier, target FROM met QUALIFY tier = min(tier) OVER (PARTITION BY id)),
coded AS (SELECT b.*, 'S' || b.target AS symbol, p_size, CASE WHEN p_size IS NULL OR p_size = 50 THEN NULL WHEN p_size % 10 < 6 THEN 'N' WHEN p_size % 10 < 8 THEN 'I' WHEN p_size % 10 = 8 THEN 'N?' ELSE 'NI' END AS code
  FROM best b LEFT JOIN part ON p_partkey = target),
valued AS (SELECT *, CASE code WHEN 'N' THEN 'native' WHEN 'I' THEN 'introduced' END AS value,
  CASE WHEN code IS NULL THEN 'no_native_status' WHEN code = 'N?' THEN 'uncertain_native_status' WHEN code = 'NI' THEN 'conflicting_native_status' END AS why FROM coded),
agreed AS (SELECT id, min(symbol) AS symbol, count(DISTINCT value) + max((value IS NULL)::INT) AS n, max(value) AS v FROM valued GROUP BY 1),
reconciled AS (SELECT t.id, t.name, v.tier, a.symbol, CASE WHEN n = 1 THEN a.v END AS value,
  CASE WHEN a.id IS NULL THEN 'no_plants_record' WHEN n <> 1 THEN 'ambiguous_plants_match' WHEN a.v IS NULL THEN v.why END AS reason
  FROM taxa t LEFT JOIN agreed a USING (id) LEFT JOIN valued v ON v.id = a.id AND v.symbol = a.symbol)"""


@R.query(f"""{_WITH}, {_RECONCILED} SELECT id, CASE WHEN reason IS NULL THEN tier END AS tier, symbol, value, CASE WHEN value IS NOT NULL THEN CASE WHEN tier = 3 THEN 'medium' ELSE 'high' END END AS confidence, reason FROM reconciled""")
def reconciled_taxa(spark, sf_dir):
    """Taxa matched by name with a source that shares no key: tiers, homonyms that agree, the last status of a region."""
    return _reconciled(spark, sf_dir)[1]


def _established(spark, sf_dir, taxa):
    """Checklist answers from the responses to a request for every taxon: the last answer of a taxon counts, some are of another place, some silent.

    Only taxa of the pool, at most LIMIT, are asked for: their ids are sent to the scan.
    """
    asked = F.broadcast(taxa.select(F.col("id").alias("p_partkey")).distinct())
    part = table(spark, sf_dir, "part").filter("p_size % 9 <> 0").join(asked, "p_partkey", "left_semi")
    means = F.when(F.col("p_type") == "ECONOMY", "introduced").when(F.col("p_type") == "SMALL", "endemic").when(F.col("p_type") == "MEDIUM", "naturalised").otherwise("native")
    place = F.when(F.col("p_size") % 8 != 0, F.struct(F.when(F.col("p_size") % 7 == 0, F.lit(1)).otherwise(F.lit(PLACE)).cast("long").alias("id"), F.lit("x").alias("name"), F.lit(10).alias("admin_level")))
    listed = F.when(F.col("p_size") % 5 != 0, F.struct(means.alias("establishment_means"), place.alias("place")))
    entry = lambda value: F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array(F.struct(F.lit("genus").alias("rank"), F.split("p_name", " ")[0].alias("name"))).alias("ancestors"), value.alias("establishment_means"))
    bodies = part.select(F.explode(F.array(F.struct(F.lit(0).alias("ord"), entry(F.lit(None).cast(listed_type())).alias("t")), F.struct(F.lit(1).alias("ord"), entry(listed).alias("t")))).alias("e"))
    responses = bodies.select("e.ord", F.to_json(F.struct(F.array(F.col("e.t")).alias("results"))).alias("response"))
    return P.establishment(taxa.select("id"), P.taxon_details(responses), PLACE)


def listed_type() -> str:
    return "struct<establishment_means:string,place:struct<id:bigint,name:string,admin_level:int>>"


_ESTABLISHED = f"""established AS (SELECT t.id, CASE WHEN p.p_size % 9 = 0 THEN 'absent_from_response' WHEN p.p_size % 5 = 0 THEN 'no_listing' WHEN p.p_size % 8 = 0 OR p.p_size % 7 = 0 THEN 'place_not_state_scoped'
    WHEN p.p_type = 'MEDIUM' THEN 'uninterpretable_establishment_means' END AS reason, CASE WHEN p.p_type = 'ECONOMY' THEN 'introduced' ELSE 'native' END AS v
  FROM taxa t JOIN part p ON t.id = p.p_partkey)"""


@R.query(f"{_WITH}, {_ESTABLISHED} SELECT id, CASE WHEN reason IS NULL THEN v END AS value, reason FROM established")
def checklist_answers(spark, sf_dir):
    """Every taxon's answer for the place asked, or the reason for none."""
    return _established(spark, sf_dir, _pool(spark, sf_dir).taxa)


def _decided(spark, sf_dir, pool=None):
    taxa, matched = _reconciled(spark, sf_dir, pool)
    established = cut(_established(spark, sf_dir, taxa))
    ref = lambda name: F.struct(F.lit(name).alias("name"), F.lit("1").alias("version"))
    return taxa, matched, established, cut(P.decide(matched, established, ref("records"), ref("checklist")))


_DECIDED = f"""{_RECONCILED}, {_ESTABLISHED},
pair AS (SELECT r.id, r.name, r.tier, r.reason AS why, r.value AS a, CASE WHEN e.reason IS NULL THEN e.v END AS b, CASE WHEN r.tier = 3 THEN 'medium' ELSE 'high' END AS sure FROM reconciled r JOIN established e USING (id)),
decided AS (SELECT *, CASE WHEN a = b THEN 'agreement' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'conflict' WHEN a IS NULL AND b IS NULL THEN 'no_source' ELSE 'single_source' END AS outcome FROM pair)"""


@R.query(f"""{_WITH}, {_DECIDED} SELECT id, outcome, CASE WHEN outcome IN ('agreement', 'single_source') THEN coalesce(a, b) END AS value,
CASE outcome WHEN 'agreement' THEN sure WHEN 'single_source' THEN 'medium' END AS confidence, CASE outcome WHEN 'agreement' THEN 'records,checklist' WHEN 'single_source' THEN CASE WHEN a IS NULL THEN 'checklist' ELSE 'records' END END AS sources,
CASE outcome WHEN 'conflict' THEN 'source_conflict' WHEN 'no_source' THEN 'no_nativity_source' END AS reason FROM decided""")
def decided_taxa(spark, sf_dir):
    rows = _decided(spark, sf_dir)[3]
    return rows.withColumn("sources", F.array_join(F.transform("sources", lambda s: s["name"]), ","))


def _manifest(spark, sf_dir):
    pool = _pool(spark, sf_dir)  # one pool for what both branches need
    taxa, matched, established, decisions = _decided(spark, sf_dir, pool)
    _, resolved, _, _ = _resolved(spark, sf_dir, pool)
    excluded = taxa.filter("genus = 'blue' AND id % 3 = 0").select("id")
    demoted = spark.createDataFrame([("cold",), ("green",)], "genus string")
    held = resolved.select(F.col("taxon_id").alias("id")).distinct()
    return taxa.join(held, "id", "left_semi"), resolved, matched, established, decisions, excluded, demoted


_MANIFEST = f"""{_RESOLVED}, {_DECIDED},
pack AS (SELECT d.*, genus, genus = 'blue' AND d.id % 3 = 0 AS excluded, CASE WHEN genus IN ('cold', 'green') THEN 'genus' ELSE 'species' END AS answer_rank,
    CASE WHEN outcome IN ('agreement', 'single_source') THEN coalesce(a, b) END AS value, CASE outcome WHEN 'agreement' THEN sure WHEN 'single_source' THEN 'medium' END AS confidence
  FROM decided d JOIN taxa USING (id) WHERE d.id IN (SELECT t FROM resolved))"""


@R.query(f"""{_WITH}, {_MANIFEST} SELECT id, name, genus, answer_rank, value, confidence, CASE outcome WHEN 'agreement' THEN 2 ELSE 1 END AS n_sources,
(SELECT string_agg(h, ',' ORDER BY place) FROM resolved WHERE t = id) AS image_hashes FROM pack WHERE NOT excluded AND value IS NOT NULL""")
def manifest_taxa(spark, sf_dir):
    """The promoted taxa, each with its claim, how it is asked, and its images in order."""
    taxa, resolved, _, _, decisions, excluded, demoted = _manifest(spark, sf_dir)
    promoted, _ = P.manifest(taxa, resolved, decisions, excluded, demoted)
    return promoted.select("id", "name", "genus", "answer_rank", "claim.value", "claim.confidence", F.size("claim.sources").alias("n_sources"), F.array_join("image_hashes", ",").alias("image_hashes"))


@R.query(f"""{_WITH}, {_MANIFEST} SELECT id, name, CASE WHEN excluded THEN 'curated_exclusion' WHEN outcome = 'conflict' THEN 'source_conflict' ELSE 'no_nativity_source' END AS reason,
CASE WHEN excluded THEN 'grown for sale [policy]' || CASE WHEN name = lower(name) THEN '' ELSE ' (made for ''' || lower(name) || ''', now ''' || name || ''': look again)' END
  WHEN outcome = 'conflict' THEN a || ' against ' || b ELSE 'no_nativity_source' END AS detail FROM pack WHERE excluded OR value IS NULL""")
def manifest_unmatched(spark, sf_dir):
    """Every taxon that isn't promoted, with reason and detail; an exclusion written under another name says so."""
    taxa, _, matched, established, decisions, excluded, _ = _manifest(spark, sf_dir)
    entries = taxa.join(excluded, "id", "left_semi").select(F.lit("mi").alias("state"), "id", F.lower("name").alias("name"), F.lit("grown for sale").alias("reason"), F.lit("policy").alias("source"))
    policy = promote.for_state(entries, "MI")
    both = matched.select("id", F.col("value").alias("first")).join(established.select("id", F.col("value").alias("second")), "id")
    detail = F.when(F.col("reason") == "source_conflict", F.format_string("%s against %s", "first", "second")).otherwise(F.col("reason"))
    reasons = decisions.filter("reason IS NOT NULL").join(both, "id").select("id", "reason", detail.alias("detail"))
    refused = taxa.select("id", "name").join(decisions.filter("value IS NOT NULL").join(excluded, "id", "left_anti"), "id", "left_anti")
    return promote.unmatched_details(refused, "id", "name", policy, reasons)


def _audit(spark, sf_dir):
    taxa, _, matched, established, decisions, excluded, demoted = _manifest(spark, sf_dir)
    why = decisions.filter("reason IS NOT NULL").select("id", "reason")
    decided = promote.promote(taxa.select("id", "name", "genus"), "id", excluded, decisions.filter("value IS NOT NULL").select("id", "value"), why)
    ranked = promote.answer_rank(decided, demoted, "genus")
    fused = decisions.select("id", "outcome").join(matched.select("id", F.col("value").alias("first")), "id").join(established.select("id", F.col("value").alias("second")), "id")
    return cut(ranked), matched, cut(fused), taxa


@R.query(f"""{_WITH}, {_MANIFEST} SELECT count(*) FILTER (NOT excluded AND value IS NOT NULL) AS promoted, count(*) FILTER (excluded OR value IS NULL) AS unmatched, count(*) FILTER (excluded) AS excluded,
count(*) FILTER (NOT excluded AND value IS NOT NULL AND answer_rank = 'genus') AS demoted,
count(*) FILTER (NOT excluded AND value = 'native') AS native, count(*) FILTER (NOT excluded AND value = 'introduced') AS introduced FROM pack""")
def promotion_counters(spark, sf_dir):
    counts = promote.counters(_audit(spark, sf_dir)[0])
    value = lambda v: F.coalesce(F.try_element_at("by_value", F.lit(v)), F.lit(0)).alias(v)
    return counts.select("promoted", "unmatched", "excluded", "demoted", value("native"), value("introduced"))


@R.query(f"""{_WITH}, {_MANIFEST} SELECT
(SELECT count(*) FROM pack WHERE outcome = 'agreement') AS agreement, (SELECT count(*) FROM pack WHERE outcome = 'no_source') AS no_source,
(SELECT count(*) FROM pack WHERE NOT excluded AND value IS NOT NULL) AS promoted, (SELECT count(*) FROM pack WHERE excluded OR value IS NULL) AS unmatched,
(SELECT coalesce(string_agg(tier || '=' || n, ',' ORDER BY tier), '') FROM (SELECT tier, count(*) AS n FROM reconciled WHERE reason IS NULL GROUP BY 1)) AS by_tier,
(SELECT coalesce(string_agg(value || '=' || n, ',' ORDER BY value), '') FROM (SELECT value, count(*) AS n FROM pack WHERE NOT excluded AND value IS NOT NULL GROUP BY 1)) AS by_value,
(SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM pack WHERE NOT excluded AND value IS NOT NULL AND answer_rank = 'genus') AS demoted,
(SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM pack WHERE excluded) AS excluded,
(SELECT coalesce(string_agg(name || ':' || a || ':' || b, ',' ORDER BY name, a, b), '') FROM pack WHERE outcome = 'conflict') AS conflicts,
(SELECT coalesce(string_agg(name || ':' || CASE WHEN a IS NULL THEN 'second' ELSE 'first' END || ':' || coalesce(a, b), ',' ORDER BY name, a IS NULL, coalesce(a, b)), '') FROM pack WHERE outcome = 'single_source') AS single_source""")
def promotion_report(spark, sf_dir):
    """The ten keys of the promotion's audit; lists are written out for comparison."""
    row = promote.report(*_audit(spark, sf_dir))
    counts = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(c)
    triples = lambda c, *k: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[i] for i in k])), ",").alias(c)
    return row.select("agreement", "no_source", "promoted", "unmatched", counts("by_tier"), counts("by_value"), F.array_join("demoted", ",").alias("demoted"), F.array_join("excluded", ",").alias("excluded"),
                      triples("conflicts", "name", "first", "second"), triples("single_source", "name", "source", "value"))


@R.query(f"""{_WITH}, {_MANIFEST}, cards AS (SELECT *, CASE outcome WHEN 'agreement' THEN '2' ELSE '1' END AS s FROM pack WHERE NOT excluded AND value IS NOT NULL)
SELECT 'cards' AS section, 'taxa' AS key, count(*) AS n FROM cards UNION ALL SELECT 'cards', 'images', count(*) FROM resolved WHERE t IN (SELECT id FROM cards)
UNION ALL SELECT 'values', value, count(*) FROM cards GROUP BY 2 UNION ALL SELECT 'confidence', confidence, count(*) FROM cards GROUP BY 2
UNION ALL SELECT 'unmatched', CASE WHEN excluded THEN 'excluded' WHEN outcome = 'conflict' THEN 'source_conflict' ELSE 'no_nativity_source' END, count(*) FROM pack WHERE excluded OR value IS NULL GROUP BY 2""")
def manifest_summary(spark, sf_dir):
    taxa, resolved, _, _, decisions, excluded, demoted = _manifest(spark, sf_dir)
    promoted, unmatched = P.manifest(taxa, resolved, decisions, excluded, demoted)
    return _statistics(P.manifest_statistics(cut(promoted), unmatched), "cards", "values", "confidence", "unmatched")


@R.query(f"""{_WITH}, {_RESOLVED}, dup AS (SELECT h FROM resolved GROUP BY 1 HAVING count(*) > 1) SELECT 'duplicate_image' AS "constraint", h AS key FROM dup""")
def manifest_integrity(spark, sf_dir):
    """Broken constraints of a manifest of all resolved taxa: contents that several taxa share are one image given twice."""
    taxa, resolved, *_ = _manifest(spark, sf_dir)
    digests = resolved.groupBy(F.col("taxon_id").alias("id")).agg(F.collect_list("sha256").alias("image_hashes"))
    claims = taxa.select("id").join(digests, "id").withColumn("claim", F.struct(F.array(F.lit("x")).alias("sources")))
    return P.manifest_violations(cut(claims), cut(resolved))


@R.query("SELECT doc_id, 'P' || (doc_id % 5) AS asked, doc_id % 5 * 10 AS place_id FROM documents")
def places_lookup(spark, sf_dir):
    """A dimension looked up by code, whatever its case; an unknown code would be an error."""
    places = spark.createDataFrame([(f"P{k}", k * 10) for k in range(5)], "code string, place_id long")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("p"), (F.col("doc_id") % 5).cast("string")).alias("code"))
    return tables.lookup(docs, places, F.col("code"), "code", "place_id").select("doc_id", F.upper("code").alias("asked"), "place_id")


@R.query(f"""{_WITH}, all_drops AS (SELECT 'candidates' AS stage, id, NULL::BIGINT AS photo_id, reason FROM drops)
SELECT stage, reason, count(*) AS n FROM all_drops GROUP BY ALL UNION ALL SELECT 'resolve', reason, count(*) FROM (WITH {_RESOLVED} SELECT * FROM lost) GROUP BY 2""")
def all_drops(spark, sf_dir):
    """The ledgers of all stages as one, by stage and reason."""
    pool, _, drops, _ = _resolved(spark, sf_dir)
    early = pool.drops.select(F.lit("candidates").alias("stage"), "id", F.lit(None).cast("long").alias("photo_id"), "reason")
    late = drops.select(F.lit("resolve").alias("stage"), F.col("taxon_id").alias("id"), "photo_id", "reason")
    return ledger.union_ledgers(early, late).groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))


@R.query("""SELECT l_partkey AS taxon_id, i AS id, l_suppkey AS login, greatest((l_quantity - 25)::INT, 0) AS agreements, photo_id, license FROM (
  SELECT *, l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey % 100000 AS i, i * 10 + CASE WHEN l_returnflag <> 'R' THEN 0 WHEN l_linestatus = 'O' THEN 1 END AS photo_id,
  CASE l_returnflag WHEN 'A' THEN 'cc0' WHEN 'N' THEN 'cc-by' ELSE CASE WHEN l_linestatus = 'O' THEN 'cc-by-sa' END END AS license FROM lineitem)""")
def projected_observations(spark, sf_dir):
    """Observations written as a response's JSON and projected again: the first photo in list order of an allowed licence, null if there is none."""
    raw = _observations(spark, sf_dir)
    body = raw.select("taxon_id", F.to_json(F.struct(F.array(F.struct("id", "num_identification_agreements", "user", "photos", F.lit("ignored").alias("extra"))).alias("results"))).alias("body"))
    row = body.select("taxon_id", nested.project(F.col("body"), "observations")["results"][0].alias("o"))
    photo = nested.usable_photo(F.col("o.photos"))
    return row.select("taxon_id", "o.id", F.substring("o.user.login", 2, 20).cast("long").alias("login"), nested.agreement_count(F.col("o.num_identification_agreements")).alias("agreements"), photo["id"].alias("photo_id"), photo["license_code"].alias("license"))


@R.query("""SELECT p_partkey AS symbol, p_name AS binomial, p_type = 'LARGE' AS is_infraspecific, p_size % 4 = 0 AND p_partkey % 10 <> 0 AS is_synonym FROM part WHERE p_size % 6 <> 0""")
def projected_search(spark, sf_dir):
    """Marked-up hits of the second source: first italic block, infraspecific marker, synonyms; hits without a name in italics are left out."""
    marker = F.when(F.col("p_type") == "LARGE", " L. var. <i>x</i>").otherwise(" L.")
    name = F.when(F.col("p_size") % 6 == 0, F.col("p_name")).otherwise(F.concat(F.lit("<i>"), F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit("</i>"), marker))
    key = lambda c: F.concat(F.lit("S"), c.cast("string"))
    accepted = F.when(F.col("p_size") % 4 == 0, key(F.col("p_partkey") - F.col("p_partkey") % 10))
    hit = F.struct(key(F.col("p_partkey")).alias("Symbol"), name.alias("ScientificName"), accepted.alias("AcceptedSymbol"), F.lit("").alias("SynonymSymbol"))
    rows = table(spark, sf_dir, "part").select(F.explode(nested.search_hits(F.array(hit))).alias("r"))
    return rows.select(F.substring("r.symbol", 2, 20).cast("long").alias("symbol"), "r.binomial", "r.is_infraspecific", "r.is_synonym")
