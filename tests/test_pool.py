"""The curation pipeline end to end on a small hand-made state."""

import pytest
from pyspark.sql import functions as F

from granary.operators import sampling
from granary.plans import pool as P

OBSERVATION = "taxon_id long, bucket string, ord long, id long, num_identification_agreements int, user struct<login:string,name:string>, photos array<struct<id:long,license_code:string,url:string>>"
REF = lambda name: F.struct(F.lit(name).alias("name"), F.lit("v").alias("version"))


def observations(taxon, n, observers=9, license="CC-BY", start=0):
    rows = []
    for k in range(n):
        i = taxon * 1000 + start + k
        photos = [(i * 10, None, f"https://h/p/{i}/square.jpg"), (i * 10 + 1, license, f"https://h/p/{i}/square.jpg?1")]
        rows.append((taxon, "ABCD"[k % 4], k, i, -3, (f"u{k % observers}", ""), photos))
    return rows


@pytest.fixture(scope="module")
def pool(spark):
    summaries = [(0, 1, "Acer campestre", "species", 900), (1, 2, "Mentha × piperita", "species", 800), (2, 1, "Acer campestre", "species", 900), (3, 3, "Acer", "genus", 700),
                 (4, 4, "Carex riparia", "species", 600), (5, 5, "Rosa lost", "species", 500), (6, 6, "Quercus thin", "species", 400), (7, 7, "Robinia viscosa", "species", 300),
                 (8, 8, "Rare thing", "species", 49), (9, 9, "Tilia late", "species", 45), (10, 10, "Ulmus unreached", "species", 200)]
    details = [(i, g, "f") for i, g in ((1, "Acer"), (4, "Carex"), (6, "Quercus"), (7, "Robinia"), (10, "Ulmus"))]
    seen = observations(1, 12) + observations(4, 8, observers=3) + observations(6, 3) + observations(7, 9) + observations(10, 9) + observations(6, 9, license="cc-by-nc", start=50) + [(1, "D", 0, 1000, 0, ("u0", "x"), [(5, "cc0", "https://h/p/1/square.jpg")])]
    return P.Pool(*(x.cache() for x in P.candidate_pool(
        spark.createDataFrame(summaries, "ord long, id long, name string, rank string, count long"), spark.createDataFrame(details, "id long, genus string, family string"),
        spark.createDataFrame(seen, OBSERVATION), 3,
    )))


def test_candidates(pool):
    assert [r.id for r in pool.taxa.orderBy("ord").collect()] == [1, 4, 7]
    assert {(r.id, r.reason) for r in pool.drops.collect()} == {
        (2, "hybrid"), (3, "not_species_rank"), (5, "taxon_detail_unavailable"), (6, "insufficient_licensed_photos"), (8, "below_observation_floor"), (9, "below_observation_floor"),
    }
    assert all(r.detail for r in pool.drops.collect())
    one = pool.photos.filter("taxon_id = 1").orderBy("place").collect()
    assert [(r.bucket, r.observation_id) for r in one] == [(b, 1000 + k) for k, b in enumerate("ABCDABCD")]
    assert all(r.photo.license_code == "cc-by" and r.agreements == 0 and r.observer_name is None for r in one)
    four = pool.photos.filter("taxon_id = 4").collect()
    assert len(four) == 6 and max(sum(x.observer == r.observer for x in four) for r in four) == sampling.OWNER_CAP
    assert P.pool_violations(pool).count() == 0
    found = P.pool_statistics(pool)
    assert {r.reason: r.n for r in found["reasons"].collect()}["below_observation_floor"] == 2 and tuple(found["observations"].first()) == (600, 300)


def test_resolve_decide_and_promote(spark, pool):
    wanted = pool.photos.select("taxon_id", F.col("photo.id").alias("photo_id"), F.col("photo.url").alias("url")).collect()
    answers = []
    for r in wanted:
        url = r.url.replace("square", "medium")
        bad = r.photo_id % 7 == 0 and r.taxon_id == 1
        content = b"" if bad else b"same" if r.photo_id in (70001, 70011) else str(r.photo_id).encode()
        answers.append((url, 200, "image/jpeg", content))
    responses = spark.createDataFrame(answers, "url string, status int, content_type string, content binary")
    images, drops = (x.cache() for x in P.resolve(pool.photos, responses, spark.createDataFrame([], "photo_id long, sha256 string")))
    assert {r.reason for r in drops.collect()} <= {"empty_body", "duplicate_content"} and drops.filter("reason = 'duplicate_content'").count() == 1
    assert images.count() + drops.count() == len(wanted)
    again, _ = P.resolve(pool.photos, responses.limit(0), images.select("photo_id", "sha256"))
    assert again.count() == images.count()
    _, lost = P.resolve(pool.photos, responses.limit(0), images.limit(0).select("photo_id", "sha256"))
    assert lost.filter("reason = 'insufficient_resolved_photos'").count() == 3

    records = [("ACRU", "Acer campestre", False, "", False), ("CAIN", "Carex riparia", False, "", False), ("CAIN2", "Carex riparia", False, "", False), ("ROPS", "ROBINIA viscosa", False, "", False)]
    statuses = [("ACRU", "L48", "I", 0), ("ACRU", "L48", "N", 1), ("CAIN", "L48", "N", 0), ("CAIN2", "L48", "N", 0), ("ROPS", "L48", "N", 0)]
    matched = P.reconcile(pool.taxa, spark.createDataFrame(records, "symbol string, binomial string, is_infraspecific boolean, accepted_symbol string, is_synonym boolean"),
                          spark.createDataFrame(statuses, "symbol string, region string, status string, pos int")).cache()
    assert {tuple(r) for r in matched.collect()} == {(1, 1, "ACRU", "native", "high", None), (4, 1, "CAIN", "native", "high", None), (7, 3, "ROPS", "native", "medium", None)}

    means = "id long, ord int, establishment_means struct<establishment_means:string,place:struct<id:long,name:string,admin_level:int>>"
    listed = P.establishment(pool.taxa, spark.createDataFrame([(1, 0, ("introduced", (29, "MI", 10))), (1, 1, ("endemic", (29, "MI", 10))), (7, 0, ("introduced", (29, "MI", 10))), (4, 0, ("native", (1, "US", 0)))], means), 29).cache()
    assert {tuple(r) for r in listed.collect()} == {(1, "native", None), (7, "introduced", None), (4, None, "place_not_state_scoped")}

    decisions = P.decide(matched, listed, REF("first"), REF("second")).cache()
    assert {(r.id, r.outcome, r.confidence, len(r.sources or [])) for r in decisions.collect()} == {(1, "agreement", "high", 2), (4, "single_source", "medium", 1), (7, "conflict", None, 0)}
    none, genera = pool.taxa.select("id").limit(0), spark.createDataFrame([("Carex",)], "genus string")
    promoted, unmatched = (x.cache() for x in P.manifest(pool.taxa, images, decisions, none, genera))
    assert {(r.id, r.answer_rank) for r in promoted.collect()} == {(1, "species"), (4, "genus")} and [(r.id, r.reason) for r in unmatched.collect()] == [(7, "source_conflict")]
    assert P.manifest_violations(promoted, images.filter("taxon_id <> 7")).count() == 0
    assert {r.constraint for r in P.manifest_violations(promoted, images).collect()} == {"orphan_image"}
    excluded, rest = P.manifest(pool.taxa, images, decisions, pool.taxa.select("id").filter("id = 1"), genera)
    assert [r.id for r in excluded.collect()] == [4] and {(r.id, r.reason) for r in rest.collect()} == {(1, "excluded"), (7, "source_conflict")}
    assert P.unreferenced(images, [images.filter("taxon_id = 1"), images.filter("taxon_id = 4")]).count() == images.filter("taxon_id = 7").select("sha256").distinct().count()
