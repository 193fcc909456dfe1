import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import images, nested, store
from granary.sources import cache, fetching, files, tables
from granary.streaming import incremental


def test_cache_key_is_canonical(spark):
    got = spark.range(1).select(cache.cache_key("e", {"b": F.lit("x"), "a": F.lit(3)}, 2).alias("k")).first().k
    assert got == hashlib.sha256(b'{"endpoint":"e","params":{"a":3,"b":"x"},"projection_version":2}').hexdigest()


def test_envelopes(spark, tmp_path):
    response = T._parse_datatype_string(f"struct<results:array<{nested.SCHEMAS['species_counts']}>>")
    for k, version in enumerate((1, 2)):
        body = {"endpoint": "species_counts", "params": {"page": str(k)}, "projection_version": version, "fetched_at": "2026-01-01", "response": {"results": [{"count": k}]}}
        (tmp_path / f"{k}.json").write_text(json.dumps(body))
    rows = cache.read_envelopes(spark, str(tmp_path), response, 2).collect()
    assert len(rows) == 1 and rows[0].response.results[0]["count"] == 1
    (tmp_path / "bad.json").write_text('{"other": 1}')
    with pytest.raises(Exception, match="not a cache envelope"):
        cache.read_envelopes(spark, str(tmp_path), response).collect()


def test_format_marks(spark, tmp_path):
    new = str(tmp_path / "new")
    assert not files.claim_folder(spark, new, "cache", {"version": 1}, ("version",)) and not files.claim_folder(spark, new, "cache", {"version": 1}, ("version",))
    assert files.claim_folder(spark, new, "cache", {"version": 2}, ("version",)) and not files.claim_folder(spark, new, "cache", {"version": 2})
    with pytest.raises(files.FormatError, match="was written with"):
        files.claim_folder(spark, new, "cache", {"version": 3})
    with pytest.raises(files.FormatError, match="foreign"):
        files.claim_folder(spark, new, "store", {"version": 2})
    (tmp_path / "x.json").write_text("{}")
    with pytest.raises(files.FormatError, match="without a format mark"):
        files.claim_folder(spark, str(tmp_path), "cache", {})
    (tmp_path / "_FORMAT").write_text("{")
    with pytest.raises(files.FormatError, match="unreadable"):
        files.claim_folder(spark, str(tmp_path), "cache", {})


def test_one_writer_at_a_time(spark, tmp_path):
    path = str(tmp_path)
    with files.lock(spark, path):
        with pytest.raises(files.LockedError), files.lock(spark, path):
            pass
        with files.lock(spark, path, "_OTHER"):
            pass
    for held in ("nonsense", json.dumps({"host": files.socket.gethostname(), "pid": 2**22 + 1, "since": 0}), json.dumps({"host": "elsewhere", "pid": 1, "since": 0})):
        (tmp_path / "_LOCK").write_text(held)
        with files.lock(spark, path):
            assert (tmp_path / "_LOCK").exists()
        assert not (tmp_path / "_LOCK").exists()
    (tmp_path / "_LOCK").write_text(json.dumps({"host": "elsewhere", "pid": 1, "since": 9e12}))
    with pytest.raises(files.LockedError), files.lock(spark, path):
        pass
    with files.lock(spark, path, force=True):
        pass


def test_commit_replaces_in_one_move_and_retires_the_journal(spark, tmp_path):
    path, journal = str(tmp_path / "pool"), str(tmp_path / "journal")
    cache.append_journal(spark.range(2), journal)
    files.commit(spark.range(3), path)
    files.commit(spark.range(5), path, retire=journal)
    assert spark.read.json(path).count() == 5 and not (tmp_path / "journal").exists() and {x.name for x in tmp_path.iterdir()} == {"pool"}


def test_stage_inputs_tell_missing_from_stale(spark, tmp_path):
    path = str(tmp_path / "pool")
    with pytest.raises(tables.MissingTable):
        tables.read_nested(spark, path, "id long")
    files.commit(spark.createDataFrame([(1, [(2, "a")])], "id long, photos array<struct<n:long,u:string>>"), path)
    assert tables.read_nested(spark, path, "id long, photos array<struct<n:long,u:string,later:int>>").first().photos[0].n == 2
    for other in ("id long", "id long, photos array<struct<n:long>>", "id long, photos array<long>"):
        with pytest.raises(tables.StaleTable):
            tables.read_nested(spark, path, other)


def test_pacing_and_backoff():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    call = fetching.paced(lambda url: url, 0.7, sleep, lambda: now[0])
    assert [call(x) for x in "abc"] == ["a", "b", "c"] and slept == pytest.approx([0.7, 0.7])
    answers = [fetching.Response(429), fetching.Response(429, retry_after="0.2"), fetching.Response(429, retry_after="soon"), fetching.Response(200)]
    slept.clear()
    assert fetching.with_backoff(lambda _: answers.pop(0), sleep=sleep)("u").status == 200 and slept == [30, 1, 120]
    slept.clear()
    with pytest.raises(fetching.ThrottledError):
        fetching.with_backoff(lambda _: fetching.Response(429), sleep=sleep)("u")
    assert slept == [30, 60, 120, 240]


def test_fetching_keeps_order_and_turns_failures_into_outcomes(spark):
    def make_call():
        def call(url):
            if url == "u3":
                raise OSError("down")
            return fetching.Response(200, "image/jpeg", url.encode())

        return call

    got = fetching.fetch_each(make_call)(spark.createDataFrame([(k, f"u{k}") for k in range(20)], "k int, url string").coalesce(1)).collect()
    assert [(r.k, r.status, r.content_type, r.body and bytes(r.body)) for r in got] == [(k, -1, "OSError", None) if k == 3 else (k, 200, "image/jpeg", f"u{k}".encode()) for k in range(20)]


def test_read_through(spark, tmp_path):
    path, asked = str(tmp_path / "c"), []
    requests = spark.createDataFrame([(f"k{n}", "e", {"n": str(n)}, n) for n in (1, 2, 2, 3)], "key string, endpoint string, params map<string,string>, n long")

    def fetch(missing):
        asked.append(sorted(r.n for r in missing.collect()))
        body = F.when(F.col("n") == 3, "<html>").otherwise(F.format_string('{"n": %d, "more": 1}', "n"))
        return missing.withColumns({"status": F.lit(200), "content_type": F.lit("application/json"), "body": F.encode(body, "utf-8")})

    project = lambda body: F.to_json(F.from_json(body, "struct<n:long>"))
    with pytest.raises(fetching.CacheMissError):
        fetching.read_through(requests, path, None, project, 1)
    with pytest.raises(ValueError, match="undecodable"):
        fetching.read_through(requests, path, fetch, project, 1, keep_raw=True)
    entries, counters = fetching.read_through(requests.filter("n < 3"), path, None, project, 1)
    assert sorted((r.key, r.response) for r in entries.collect()) == [("k1", '{"n":1}'), ("k2", '{"n":2}')] and tuple(counters.first()) == ("e", 2, 0)
    assert asked == [[1, 2, 3]] and spark.read.json(f"{path}/raw").count() == 2
    fetching.read_through(requests.filter("n < 3"), path, fetch, project, 2)
    assert asked[1:] == [[1, 2]]  # another version's entries are never read
    assert fetching.cost_summary(counters).first().line == "2 requests: 2 cached, 0 fetched"
    assert fetching.file_version(spark, path).first().version is not None and fetching.file_version(spark, path + "-none").first().version is not None


def test_plain_json(spark):
    df = spark.sql("SELECT struct(timestamp'2026-01-02 03:04:05' AS a, array(date'2026-01-02') AS b, map('k', timestamp_ntz'2026-01-02 03:04:05.5') AS c, 1.5D AS d, CAST(null AS struct<x:date>) AS e) AS v")
    got = df.select(F.to_json(fetching.plain_json(F.col("v"), df.schema["v"].dataType)).alias("j")).first().j
    assert json.loads(got) == {"a": "2026-01-02T03:04:05Z", "b": ["2026-01-02"], "c": {"k": "2026-01-02T03:04:05.500000"}, "d": 1.5}
    for bad, path in (("struct<a:array<binary>>", r"\$\.a\[\*\]"), ("map<int,string>", r"\$ has keys")):
        with pytest.raises(TypeError, match=path):
            fetching.plain_json(F.col("v"), T._parse_datatype_string(bad))


def test_places_are_refreshed_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "places")
    found = spark.createDataFrame([("Ohio", [(1, "Ohio", 100, [1]), (31, "Ohio", 10, [1, 9])]), ("Utah", [(52, "Utah", 10, [2])])], "name string, results array<struct<id:long,name:string,admin_level:int,ancestor_place_ids:array<long>>>")
    states = spark.createDataFrame([("OH", "Ohio"), ("UT", "Utah")], "code string, name string")
    with pytest.raises(LookupError, match="UT"):
        tables.refreshed_places(states, found, path)
    assert not files.exists(spark, path)
    tables.refreshed_places(states.filter("code = 'OH'"), found, path)
    assert [tuple(r) for r in spark.read.json(path).select("code", "place_id").collect()] == [("OH", 31)]


def test_store_takes_contents_once_and_drops_what_nothing_refers_to(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = store.addressed(spark.createDataFrame([(str(k),) for k in range(30)] + [("1",)], "t string"), "t")
    assert store.write_contents(rows, path).count() == 30 and store.write_contents(rows, path).count() == 0
    wanted = rows.filter("t < '2'")
    gone = store.collect(spark, path, wanted)
    assert gone.count() == 30 - wanted.dropDuplicates().count() and store.stored(spark, path).count() == 30
    store.collect(spark, path, wanted, dry_run=False)
    assert sorted(r.t for r in spark.read.parquet(path).collect()) == sorted({r.t for r in wanted.collect()})
    assert store.collect(spark, str(tmp_path / "none"), wanted).count() == 0


def test_journal_skips_truncated_lines(spark, tmp_path):
    (tmp_path / "j.json").write_text('{"id": 1, "v": "a", "at": 1}\n{"id": 2, "v": "b", "at": 2}\n{"id": 1, "v": "c", "at": 3}\n{"id": 2, "v": "tr')
    schema = T._parse_datatype_string("id long, v string, at long")
    assert {(r.id, r.v) for r in cache.replay_journal(spark, str(tmp_path / "j.json"), schema, "id", "at").collect()} == {(1, "c"), (2, "b")}


def test_policies_ledgers_and_reports(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"state": "MI", "id": k} for k in range(4)]))
    assert tables.read_policy(spark, str(tmp_path / "p.json"), "state string, id long", "state", 4).count() == 4
    with pytest.raises(ValueError, match="more than 3"):
        tables.read_policy(spark, str(tmp_path / "p.json"), "state string, id long", "state", 3)
    dropped = spark.createDataFrame([(2, "b", "r"), (1, "a", "r")], "id long, name string, reason string")
    tables.write_ledger(dropped, str(tmp_path / "l"), "name")
    assert [r.name for r in tables.read_ledger(spark, str(tmp_path / "l")).collect()] == ["a", "b"]
    tables.write_ledger(dropped.limit(0), str(tmp_path / "e"), "name")
    with pytest.raises(ValueError, match="empty"):
        tables.write_nonempty(dropped.limit(0), str(tmp_path / "n"))
    assert tables.directory_size(spark, str(tmp_path / "l")).first().bytes > 0
    assert tuple(tables.directory_size(spark, str(tmp_path / "none")).first()) == (0, 0)
    places = spark.createDataFrame([("MI", 29)], "code string, place long")
    assert tables.lookup(spark.createDataFrame([("mi",)], "c string"), places, F.col("c"), "code", "place").first().place == 29
    with pytest.raises(Exception, match="unknown code"):
        tables.lookup(spark.createDataFrame([("zz",)], "c string"), places, F.col("c"), "code", "place").collect()


def test_streams_fill_the_store_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "store")
    for k in range(2):
        spark.createDataFrame([("a",), ("b",), (f"c{k}",)], "t string").write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("t string").parquet(str(source))
        incremental.stream_into_store(stream, "t", out, str(tmp_path / "check")).awaitTermination(60)
    assert sorted(r.t for r in spark.read.parquet(out).collect()) == ["a", "b", "c0", "c1"]


def test_windowed_counts_leave_out_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.sql("SELECT timestamp'2026-01-01 00:10:00' AS ts, 'a' AS b UNION ALL SELECT timestamp'2026-01-01 00:50:00', 'a' UNION ALL SELECT timestamp'2026-01-01 05:00:00', 'b'")
    for part in (rows, spark.sql("SELECT timestamp'2026-01-01 00:20:00' AS ts, 'a' AS b UNION ALL SELECT timestamp'2026-01-01 09:00:00', 'b'")):
        part.coalesce(1).write.mode("append").parquet(source)
        counts = incremental.bucket_counts(spark.readStream.schema("ts timestamp, b string").parquet(source), "ts", "b")
        counts.writeStream.outputMode("append").format("json").option("checkpointLocation", str(tmp_path / "check")).option("path", out).trigger(availableNow=True).start().awaitTermination(60)
    got = spark.read.schema("start timestamp, b string, n long").json(out).collect()
    assert sorted((r.start.hour, r.b, r.n) for r in got) == [(0, "a", 2), (5, "b", 1)]


def test_bytes_pass_through_a_given_codec(spark):
    def make_codec():
        return lambda data: (data.upper(), len(data), 1) if data != b"bad" else None

    got = images.transcoded(spark.createDataFrame([(1, b"ab"), (2, b"bad"), (3, None)], "id int, content binary"), "content", make_codec).collect()
    assert [(r.id, r.content and bytes(r.content), r.width, r.height, r.reason) for r in got] == [(1, b"AB", 2, 1, None), (2, None, None, None, "not_decodable"), (3, None, None, None, "empty_body")]


def test_a_store_reads_only_the_shards_that_come_in(spark, tmp_path):
    path = str(tmp_path / "images")
    rows = store.addressed(spark.createDataFrame([(f"content {k}".encode(),) for k in range(300)], "content binary"), "content").cache()
    numbers = rows.filter("shard rlike '^0[0-9]$'")  # shards that look like numbers only
    assert store.write_contents(numbers, path).count() == numbers.count() > 0
    assert {r.shard for r in store.stored(spark, path).collect()} == {r.shard for r in numbers.collect()}
    assert store.write_contents(rows, path).count() == 300 - numbers.count()
    plan = store._entries(spark, path, ["07", "a1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan and "IN (07,a1)" in plan
    kept = rows.filter("shard <> '07' AND sha256 > '3'").select("sha256")
    before = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "images").glob("shard=*")}
    gone = store.collect(spark, path, kept, dry_run=False)
    assert {r.sha256 for r in store.stored(spark, path).collect()} == {r.sha256 for r in kept.collect()} and gone.count() == 300 - kept.count()
    after = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "images").glob("shard=*")}
    touched = {f"shard={r.shard}" for r in gone.collect()}
    assert "shard=07" not in after and all(after[k] == before[k] for k in after if k not in touched)
