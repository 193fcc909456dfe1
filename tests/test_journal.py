"""A journal followed as a stream against the journal read at once."""

import json
import random
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.claims import last_wins
from granary.sources import cache
from granary.streaming import journal

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.LongType()), T.StructField("reason", T.StringType())])


def _start(spark, tmp_path, keep_ms=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "lines"))
    return journal.keep_current(stream, "id", "at", str(tmp_path / "out"), str(tmp_path / "check"), keep_ms)


def _run(spark, tmp_path):
    query = _start(spark, tmp_path)
    assert query.awaitTermination(120) and query.exception() is None


def _current(spark, tmp_path):
    changes = spark.read.parquet(str(tmp_path / "out"))
    last = last_wins(changes.withColumn("order", F.struct("batch", "at")), ["id"], "order")
    return {r.id: (r.at, r.reason) for r in last.filter("NOT stale").collect()}


def test_a_restart_in_mid_stream_gives_what_the_whole_journal_gives(spark, tmp_path):
    rnd, places = random.Random(4), list(range(120))
    rnd.shuffle(places)
    lines = [json.dumps({"id": rnd.randint(1, 9), "at": at, "reason": rnd.choice(["lost", None, "gone"])}) for at in places] + ['{"id": 3, "at": 500, "rea', '{"id": null, "at": 501}']
    (tmp_path / "lines").mkdir()
    for part in range(4):
        (tmp_path / "lines" / f"{part}.json").write_text("\n".join(lines[part::4]))
        if part in (1, 3):
            _run(spark, tmp_path)
    want = {r.id: (r.at, r.reason) for r in cache.replay_journal(spark, str(tmp_path / "lines"), SCHEMA, "id", "at").collect()}
    assert _current(spark, tmp_path) == want and len(want) == 9
    # only changes are written: an older line that comes later is none
    changes = spark.read.parquet(str(tmp_path / "out")).filter("NOT stale").collect()
    by_id = {i: [r.at for r in sorted((r for r in changes if r.id == i), key=lambda r: r.batch)] for i in want}
    assert all(x == sorted(x) for x in by_id.values()) and sum(map(len, by_id.values())) < len(places)
    before = len(changes)
    _run(spark, tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == before


def test_keys_of_which_nothing_is_heard_expire(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "0.json").write_text('{"id": 1, "at": 1, "reason": "a"}\n{"id": 2, "at": 1, "reason": "b"}')
    query = _start(spark, tmp_path, keep_ms=500)
    try:
        gone, until = set(), time.time() + 90
        while gone != {1, 2} and time.time() < until:
            time.sleep(0.5)
            if list((tmp_path / "out").glob("batch=*/_SUCCESS")):
                gone = {r.id for r in spark.read.parquet(str(tmp_path / "out")).filter("stale").collect()}
    finally:
        query.stop()
    assert gone == {1, 2}
