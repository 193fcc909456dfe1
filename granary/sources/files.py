"""Small files beside tables, in any store that Spark reaches: format marks, commits, locks and sizes."""

from __future__ import annotations

import json
import os
import socket
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from granary.session import shared_folder


def _at(spark: SparkSession, path: str, *below: str):
    """The file system and the place of a path, or of a name below it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    for name in below:
        place = spark._jvm.org.apache.hadoop.fs.Path(place, name)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_small(spark: SparkSession, path: str, name: str) -> str | None:
    """The text of a small file that Spark's readers pass over; None if there is none."""
    fs, place = _at(spark, path, name)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, name: str, text: str, fresh: bool = False) -> None:
    """Writes a small file; fresh: an error if it exists, decided by the store."""
    fs, place = _at(spark, path, name)
    stream = fs.create(place, not fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def has_entries(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place) and any(not x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(place))


class FormatError(ValueError):
    """A folder that this build can't use."""


def claim_folder(spark: SparkSession, path: str, kind: str, profile: dict, renew: tuple[str, ...] = ()) -> bool:
    """Checks a folder's mark, or marks a folder without entries. Tells whether an older mark was renewed.

    Entries without a mark, an unreadable mark and one of another kind are errors. So is another
    profile, except in the fields named in renew: entries of other values there are never read, so the mark is renewed.
    """
    own = json.dumps({"format": kind, **profile}, sort_keys=True)
    text = read_small(spark, path, "_FORMAT")
    if text is None:
        if has_entries(spark, path):
            raise FormatError(f"{path} holds entries without a format mark")
        write_small(spark, path, "_FORMAT", own)
        return False
    try:
        found = json.loads(text)
    except ValueError as e:
        raise FormatError(f"{path} has an unreadable format mark") from e
    if not isinstance(found, dict) or found.get("format") != kind:
        raise FormatError(f"{path} has a foreign format mark")
    differs = {k for k in {*found, *profile} - {"format"} if found.get(k) != profile.get(k)}
    if differs - {*renew}:
        raise FormatError(f"{path} was written with {found}, this build writes {own}")
    if differs:
        write_small(spark, path, "_FORMAT", own)
    return bool(differs)


def commit(df: DataFrame, path: str, retire: str | None = None) -> None:
    """Writes rows beside the path, puts them in its place in one move, and deletes what they make needless, such as a journal."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    staged, before = f"{path}.{mark}.tmp", f"{path}.{mark}.old"
    df.write.json(staged)
    (fs, place), (_, made), (_, old) = (_at(spark, x) for x in (path, staged, before))
    had = fs.exists(place)
    if had and not fs.rename(place, old) or not fs.rename(made, place):
        raise OSError(f"could not move {staged} to {path}; an earlier result may be at {before}")
    if had:
        fs.delete(old, True)
    if retire:
        delete(spark, retire)


class LockedError(RuntimeError):
    """Another writer holds the lock."""


@contextmanager
def lock(spark: SparkSession, path: str, name: str = "_LOCK", force: bool = False, stale_after: float = 86_400.0):
    """Holds a folder for one writer. A lock of this host whose process is gone, or one that is too old, is stale and replaced."""
    own = {"host": socket.gethostname(), "pid": os.getpid(), "since": time.time()}
    held = read_small(spark, path, name)
    if held is not None:
        if not force and not _stale(held, own, stale_after):
            raise LockedError(f"{path} is locked: {held}")
        fs, place = _at(spark, path, name)
        fs.delete(place, False)
    try:
        write_small(spark, path, name, json.dumps(own), fresh=True)
    except Exception as e:
        raise LockedError(f"{path} was locked by another writer just now") from e
    try:
        yield
    finally:
        fs, place = _at(spark, path, name)
        fs.delete(place, False)


def _stale(held: str, own: dict, after: float) -> bool:
    try:
        found = json.loads(held)
        host, pid, since = found["host"], int(found["pid"]), float(found["since"])
    except (ValueError, KeyError, TypeError):
        return True
    if host == own["host"]:
        try:
            os.kill(pid, 0)
        except ProcessLookupError:
            return True
        except PermissionError:
            return False
        return False
    return own["since"] - since > after
