"""What the parsers do with fields that are missing, null or of another kind, and with fields a closed schema doesn't know."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import claims, guards, nested
from granary.plans import pool as P
from granary.sources import fetching, files, tables


def _texts(spark, *values):
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in enumerate(values)], "id int, body string")


def test_kinds(spark):
    rows = _texts(spark, {"a": 1}, {"a": "1"}, {"a": 1.5}, {"a": 1.0}, {"a": True}, {"a": None}, {"a": [1]}, {"a": {"a": 1}}, {}, "[1]", "{broken", {"a": 2**70})
    a = guards.at(F.try_parse_json("body"), "a")
    got = [(r.kind, r.n, r.s) for r in rows.select("id", guards.kind(a).alias("kind"), guards.read(a, T.LongType()).alias("n"), guards.read(a, T.StringType()).alias("s")).orderBy("id").collect()]
    assert got == [
        ("integer", 1, None), ("string", None, "1"), ("number", None, None), ("number", None, None), ("boolean", None, None), ("null", None, None), ("array", None, None),
        ("object", None, None), (None, None, None), (None, None, None), (None, None, None), ("number", None, None),
    ]


@pytest.mark.parametrize("taxon", [
    {"name": "Rosa alta", "rank": "species"}, {"id": 1, "rank": "species"}, {"id": 1, "name": "Rosa alta"}, {"id": None, "name": "x", "rank": "species"}, {"id": "one", "name": "x", "rank": "species"},
    {"id": 1, "name": 5, "rank": "species"}, {"id": 1, "name": "x", "rank": ["species"]}, {"id": 0, "name": "x", "rank": "species"}, {"id": 1, "name": "", "rank": "species"}, {"id": 1.0, "name": "x", "rank": "species"}, "x", None,
])
def test_a_summary_is_skipped_and_never_guessed(spark, taxon):
    good = {"count": 60, "taxon": {"id": 9, "name": "Acer campestre", "rank": "species", "preferred_common_name": 7}}
    bodies = _texts(spark, {"results": ["no object", 42, None, {"count": 100, "taxon": taxon}, {"count": "100", "taxon": good["taxon"]}, {"count": -1, "taxon": good["taxon"]}, good]}).withColumnsRenamed({"id": "ord", "body": "response"})
    kept, skipped = P.ranked_summaries(bodies)
    assert [(r.id, r.name, r["count"], r.common_name, r.ord.place) for r in kept.collect()] == [(9, "Acer campestre", 60, None, 6)]
    assert skipped.first().skipped == 6


def _observation(**changes):
    photo = {"id": 5, "license_code": "CC-BY", "url": "https://h/5/square.jpg", "original_dimensions": {"width": 4, "height": 3}}
    return {"id": 1, "uri": "https://h/1", "num_identification_agreements": 2, "user": {"login": "u", "name": "U"}, "photos": [photo]} | changes


def _usable(spark, *observations):
    rows = _texts(spark, {"results": list(observations)}).select(F.posexplode(nested.project(F.col("body"), "observations")["results"]).alias("ord", "o"))
    found = P.usable_observations(rows.select(F.lit(1).alias("taxon_id"), F.lit("A").alias("bucket"), F.col("ord").cast("long").alias("ord"), "o.*"))
    return {r.observation_id: r for r in found.collect()}


def test_observations_without_what_identifies_them_are_left_out(spark):
    bad = [{"id": "1"}, {"id": None}, {"uri": ""}, {"uri": 5}, {"user": {"login": ""}}, {"user": {"login": 7}}, {"user": "u"}, {"photos": "none"}, {"photos": None}, {"photos": []}]
    assert _usable(spark, *[_observation(**x) for x in bad], "junk", None) == {}


def test_photos_without_what_is_needed_are_passed_over(spark):
    good = _observation()["photos"][0]
    for change in ({"id": "5"}, {"url": ""}, {"url": None}, {"original_dimensions": None}, {"original_dimensions": {"width": 0, "height": 3}}, {"original_dimensions": {"width": "4", "height": 3}}, {"license_code": "all rights"}, {"license_code": 3}):
        found = _usable(spark, _observation(photos=[good | change, "junk", good | {"id": 8}]))
        assert found[1].photo.id == 8, change
    other = _usable(spark, _observation(id=2, num_identification_agreements=-4, user={"login": "u", "name": ""}), _observation(id=3, num_identification_agreements="9", user={"login": "u", "name": 5}), _observation(id=4))
    assert [(r.agreements, r.observer_name) for _, r in sorted(other.items())] == [(0, None), (0, None), (2, "U")]


def test_details_need_genus_and_family(spark):
    def taxon(i, *ancestors):
        return {"id": i, "name": "n", "ancestors": list(ancestors)}

    genus, family = {"rank": "genus", "name": "G"}, {"rank": "family", "name": "F"}
    results = [taxon(1, genus, family), taxon(2, family), taxon(3, {"rank": "genus", "name": 5}, genus, family), taxon(4, {"rank": "genus", "name": ""}, family, "junk"), {"id": 5, "ancestors": "none"}, {"id": "6"}, None]
    details = P.taxon_details(_texts(spark, {"results": results}).withColumnsRenamed({"id": "ord", "body": "response"}))
    assert {(r.id, r.genus, r.family) for r in details.collect()} == {(1, "G", "F"), (2, None, "F"), (3, "G", "F"), (4, None, "F"), (5, None, None)}
    summaries = spark.createDataFrame([(k, k, f"taxon {k}", "species", 90) for k in range(1, 7)], "ord long, id long, name string, rank string, count long")
    seen = spark.createDataFrame([], "taxon_id long, bucket string, ord long, id long, num_identification_agreements int, user struct<login:string,name:string>, photos array<struct<id:long,license_code:string,url:string>>")
    drops = {r.id: (r.reason, r.detail) for r in P.candidate_pool(summaries, details, seen, 9).drops.collect()}
    assert drops[2] == drops[4] == ("taxon_detail_unavailable", "no genus among the ancestors") and drops[6][1] == "no detail was returned"
    assert drops[1][0] == drops[3][0] == "insufficient_licensed_photos"


def test_the_last_answer_of_an_id_wins_over_several_responses(spark):
    means = lambda value: {"establishment_means": value, "place": {"id": 29, "name": "M", "admin_level": 10}}
    bodies = [("2026-01-02", "b", {"results": [{"id": 1, "establishment_means": means("native")}, {"id": 2, "establishment_means": means("native")}]}),
              ("2026-01-01", "z", {"results": [{"id": 1, "establishment_means": means("introduced")}, {"id": 3, "establishment_means": means("endemic")}]}),
              ("2026-01-02", "c", {"results": [{"id": 2, "establishment_means": means("introduced")}, {"id": 2, "establishment_means": means("endemic")}, {"id": 4, "establishment_means": {"establishment_means": 3, "place": {"id": "29"}}}]})]
    rows = spark.createDataFrame([(at, key, json.dumps(b)) for at, key, b in bodies], "at string, key string, response string").select(F.struct("at", "key").alias("ord"), "response")
    asked = spark.createDataFrame([(k,) for k in range(1, 6)], "id long")
    got = {r.id: (r.value, r.reason) for r in P.establishment(asked, P.taxon_details(rows), 29).collect()}
    assert got == {1: ("native", None), 2: ("native", None), 3: ("native", None), 4: (None, "place_not_state_scoped"), 5: (None, "absent_from_response")}
    assert [r.ord.ord.key for r in claims.last_wins(P.taxon_details(rows), ["id"], "ord").orderBy("id").collect()] == ["b", "c", "z", "c"]


def test_closed_schemas_name_every_place(spark, tmp_path):
    schema = "version int, rows array<struct<id:bigint,tags:map<string,int>,deep:struct<name:string>>>"
    rows = _texts(
        spark, {"version": 1, "rows": [{"id": 1, "tags": {"x": 1}, "deep": {"name": "n"}}, None]}, {"version": 1, "more": {"id": 1}, "rows": [{"id": 1}, {"id": 2, "old": 1, "deep": {"name": "n", "gone": []}}]},
        {"version": "1", "rows": {"id": 1}}, {"rows": [{"id": 1, "tags": {"x": "y"}, "deep": 5}]}, "{", "[]",
    )
    got = {}
    for r in tables.unreadable_places(rows, "body", T._parse_datatype_string(schema), "id").collect():
        got.setdefault(r.id, []).append(r.fault)
    assert got == {
        1: ["$.more is unknown", "$.rows[1].old is unknown", "$.rows[1].deep.gone is unknown"], 2: ["$.version is of another kind", "$.rows is no array"],
        3: ["$.rows[0].tags.x is of another kind", "$.rows[0].deep is no object"], 4: ["no JSON"], 5: ["$ is no object"],
    }
    path = str(tmp_path / "pool")
    files.commit(spark.createDataFrame([(1, [(5, None)])], "version int, rows array<struct<id:bigint,old:string>>"), path)
    assert tables.read_nested(spark, path, schema).first().rows[0].id == 5  # a null field isn't written
    files.commit(spark.createDataFrame([(1, [(5, "x")])], "version int, rows array<struct<id:bigint,old:string>>"), path)
    with pytest.raises(tables.StaleTable, match=r"\$\.rows\[0\]\.old is unknown"):
        tables.read_nested(spark, path, schema)


def test_reports_and_ledgers_read_again(spark, tmp_path):
    bad = {"agreement": "3", "no_source": 2, "by_tier": {"1": 4, "2": "5", "3": None}, "conflicts": [{"name": "b", "first": "x", "second": "y"}, {"name": "a"}, 5, {"name": "a", "first": "x", "second": "y"}], "single_source": None, "excluded": ["z", 4], "demoted": "no"}
    lines = tables.report_lines(tables.read_report(_texts(spark, bad), "body"))
    assert lines == ["sources: 0 agree, 2 conflict, 0 alone, 2 none", "tier 1: 4", "  a: x against y", "  b: x against y", "excluded: z"]
    assert tables.report_lines(tables.read_report(_texts(spark, "[]"), "body")) == ["sources: 0 agree, 0 conflict, 0 alone, 0 none"]
    (tmp_path / "ledger.csv").write_text("id,name,reason\n1,a,lost\n2,b\n3,c,\n4,d,lost\n")
    (tmp_path / "other.csv").write_text("id,name\n1,a\n")
    reasons = lambda f: sorted(r.reason for r in tables.drop_reasons(tables.read_ledger(spark, str(tmp_path / f))).collect())
    assert reasons("ledger.csv") == ["lost", "lost", "unrecorded", "unrecorded"] and reasons("other.csv") == ["unrecorded"]


def test_batches_are_full_but_for_the_last(spark):
    ids = spark.createDataFrame([(3 * (k % 95),) for k in range(400)] + [(None,)], "id long").repartition(6)
    got = sorted((r.batch, r.ids) for r in fetching.request_batches(ids, "id", 30).collect())
    assert [b for b, _ in got] == [0, 1, 2, 3] and [x for _, part in got for x in part] == [3 * k for k in range(95)] and [len(p) for _, p in got] == [30, 30, 30, 5]
    assert fetching.request_batches(ids.limit(0), "id").count() == 0
