"""Queries on tables with very large groups of equal names, and on times without microseconds, against their oracles or known rows."""

import datetime
import time

import duckdb
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from granary.operators import claims
from granary.plans import catalog, curation
from granary.plans import pool as P
from granary.sources import tables
from tests import oracle

PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@pytest.fixture
def homonyms(spark, tmp_path):
    """30,000 parts of one name and brand, every tenth of them a synonym: 900 million pairs."""
    rows = spark.range(30_000).selectExpr("id AS p_partkey", "'red bolt' AS p_name", "'B' AS p_brand", "'LARGE' AS p_type", "CASE WHEN id % 10 = 1 THEN 5 ELSE 4 END AS p_size", "1D AS p_retailprice")
    rows.write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["homonym_consensus", "tier_counts"])
def test_homonyms_are_not_paired(spark, homonyms, name):
    began, found = time.monotonic(), catalog.queries()[name](spark, homonyms).collect()
    assert time.monotonic() - began < 40
    if name == "tier_counts":
        assert sorted(map(tuple, found)) == [(1, 30_000), (2, 0), (3, 0)]
    else:
        assert len(found) == 30_000 and {tuple(r)[1:] for r in found} == {(0, "LARGE", 27_000, None)}


@pytest.mark.parametrize("part", [1000, 2])
@pytest.mark.parametrize("name", ["tiered_match", "homonym_consensus", "tier_counts"])
def test_names_in_parts_equal_the_oracle(spark, tmp_path, monkeypatch, name, part):
    """Ids that repeat under several names and under names that differ in case, sizes and kinds that are missing, groups cut into parts."""
    monkeypatch.setattr(claims, "PART", part)
    kinds = ["PROMO", "LARGE", None, "SMALL", "ECONOMY"]
    rows = [(k % 37, ["red bolt", "RED BOLT", "red nut", None][k % 4], ["A", "B", None][k % 7 % 3], kinds[k % 11 % 5], [3, 5, 15, 7, None][k % 13 % 5], 1.0) for k in range(90)]
    spark.createDataFrame(rows, PART).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    oracle.assert_same(spark, con, catalog.queries()[name], catalog.oracle_sql()[name], str(tmp_path))


def test_times_without_microseconds_equal_the_oracle(spark, tmp_path):
    rows = [(1, datetime.datetime(2024, 1, 2, 3, 4, 5), 7), (2, datetime.datetime(2024, 1, 2, 3, 4, 5, 60), 8), (3, datetime.datetime(2024, 1, 2), 9)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    oracle.assert_same(spark, con, catalog.queries()["plain_events"], catalog.oracle_sql()["plain_events"], str(tmp_path))


@pytest.mark.parametrize("sent", [100_000, 0])
def test_rows_of_few_groups_are_not_shuffled(spark, monkeypatch, sent):
    """A group's rows stay where they lie; only values inside its bracket move. With very many groups rows meet their brackets in a shuffle."""
    from granary.operators import stats

    monkeypatch.setattr(stats, "SENT", sent)
    met, join = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, *a, **k: met.append(join(self, *a, **k)) or met[-1])
    df = spark.range(20_000).selectExpr("id % 3 AS g", "cast(pmod(id * 7919, 20011) AS double) AS v")
    want = {g: sorted(k * 7919 % 20011 for k in range(g, 20_000, 3)) for g in range(3)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with a table whose groups Spark takes for large
    try:
        got = {r.g: r.p for r in stats.nearest_rank(df, ["g"], "v", 0.9, "p").collect()}
        plan = met[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {g: v[round(0.9 * (len(v) - 1))] for g, v in want.items()}
    assert ("BroadcastHashJoin" in plan) == (sent > 0)


def test_a_report_is_parsed_once(spark):
    rows = spark.createDataFrame([(1, '{"agreement": 3, "by_tier": {"1": 2, "2": "x"}, "conflicts": [{"name": "n", "first": "a", "second": "b"}, 5, {"name": "n"}], "excluded": ["x", null]}'), (2, "5"), (3, None)], "id long, body string")
    found = tables.read_report(rows, "body", "id")
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1
    got = {r.id: (r.agreement, r.no_source, r.by_tier, [tuple(x) for x in r.conflicts], r.single_source, r.excluded, r.demoted) for r in found.collect()}
    assert got == {1: (3, 0, {"1": 2}, [("n", "a", "b")], [], ["x"], []), **{k: (0, 0, {}, [], [], [], []) for k in (2, 3)}}


def test_only_the_pools_taxa_are_asked_for(spark, monkeypatch):
    """Responses and statuses of the whole part table must not meet in windows if a few taxa are asked for."""
    seen, details, last = [], P.taxon_details, claims.last_wins
    monkeypatch.setattr(P, "taxon_details", lambda bodies: seen.append(bodies.count()) or details(bodies))
    monkeypatch.setattr(claims, "last_wins", lambda df, *a: seen.append(df.count()) or last(df, *a))
    taxa = spark.range(50, 60).selectExpr("id", "'name' AS name")
    assert curation._established(spark, oracle.SF_DIR, taxa).count() == 10
    names = spark.read.parquet(f"{oracle.SF_DIR}/part.parquet").filter("p_partkey BETWEEN 50 AND 59").selectExpr("p_partkey AS id", "p_name || ' ' || p_brand AS name")
    assert P.reconcile(names, curation._records(spark, oracle.SF_DIR), curation._statuses(spark, oracle.SF_DIR)).count() == 10
    assert len(seen) == 3 and 0 < seen[0] <= 20 and 0 < seen[1] <= 20 and 0 < seen[2] <= 60
