"""The data source of cached responses: partitions, pushed filters, and writes that leave all or nothing."""

import pytest
from pyspark.sql import functions as F

from granary.sources import responses


def _entries(spark, n=40):
    rows = [(f"k{k}", ("observations", "taxa_by_id", "species_counts")[k % 3], {"page": str(k)} if k % 4 else None, 1 + k % 2, "2026-01-01", f'{{"é": {k}}}') for k in range(n)]
    return rows, spark.createDataFrame(rows, responses.ENTRY).repartition(4)


def test_written_and_read_again(spark, tmp_path):
    responses.register(spark)
    path, (rows, df) = str(tmp_path / "cache"), _entries(spark)
    empty = spark.read.format(responses.NAME).load(path)
    assert empty.count() == 0 and empty.columns == df.columns
    df.write.format(responses.NAME).mode("append").save(path)
    df.limit(0).write.format(responses.NAME).mode("append").save(path)
    got = spark.read.format(responses.NAME).load(path)
    assert sorted(tuple(r)[:2] + (r.params or {}, *tuple(r)[3:]) for r in got.collect()) == sorted((k, e, p or {}, v, a, b) for k, e, p, v, a, b in rows)
    assert sorted(p.name for p in (tmp_path / "cache").iterdir()) == ["endpoint=observations", "endpoint=species_counts", "endpoint=taxa_by_id"]
    with pytest.raises(Exception, match="only added"):
        df.write.format(responses.NAME).mode("overwrite").save(path)


def test_filters_reach_the_reader(spark, tmp_path):
    responses.register(spark)
    path, (rows, df) = str(tmp_path / "cache"), _entries(spark)
    df.write.format(responses.NAME).mode("append").save(path)
    (tmp_path / "cache" / "endpoint=species_counts" / "bad.jsonl").write_text("{broken")  # never opened below
    got = spark.read.format(responses.NAME).load(path).filter("endpoint = 'taxa_by_id' AND projection_version = 2 AND key <> 'k1'")
    assert {r.key for r in got.collect()} == {k for k, e, _, v, *_ in rows if e == "taxa_by_id" and v == 2 and k != "k1"}
    some = spark.read.format(responses.NAME).load(path).filter(F.col("endpoint").isin("taxa_by_id", "observations"))
    assert some.count() == sum(e != "species_counts" for _, e, *_ in rows)
    with pytest.raises(Exception, match="Expecting property name"):
        spark.read.format(responses.NAME).load(path).collect()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    responses.register(spark)
    path, (_, df) = str(tmp_path / "cache"), _entries(spark)
    df.write.format(responses.NAME).mode("append").save(path)
    before = sorted(str(p) for p in (tmp_path / "cache").rglob("*"))
    bad = df.withColumn("key", F.when(F.col("key") != "k7", F.concat("key", F.lit("x"))))
    with pytest.raises(Exception, match="needs a key"):
        bad.write.format(responses.NAME).mode("append").save(path)
    assert sorted(str(p) for p in (tmp_path / "cache").rglob("*")) == before
