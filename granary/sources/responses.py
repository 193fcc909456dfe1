"""Cached responses as a data source: spark.read.format("granary_responses"), a partition for some files of one endpoint.

Files lie in a directory per endpoint, in any store that Arrow's file systems reach. Filters on endpoint and projection_version are
taken over by the reader: other endpoints' files aren't listed, entries of other versions not handed on. A write is staged beside the entries and
moved in place once all its tasks have ended; one that fails leaves nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

NAME = "granary_responses"
ENTRY = "key string, endpoint string, params map<string,string>, projection_version int, fetched_at string, response string"
#: Files of one partition, and entries that are handed on at once.
FILES, ENTRIES = 64, 512
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _store(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Files(InputPartition):
    def __init__(self, endpoint: str, names: list[str]):
        self.endpoint, self.names = endpoint, names


class _Written(WriterCommitMessage):
    def __init__(self, names: list[tuple[str, str]]):
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.endpoints, self.versions = path, None, None

    def pushFilters(self, filters) -> Iterator:  # noqa: N802  (the interface's name)
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else {*f.value} if isinstance(f, In) else None
            column = getattr(f, "attribute", None)
            if values is not None and column == ("endpoint",):
                self.endpoints = values if self.endpoints is None else self.endpoints & values
            elif values is not None and column == ("projection_version",):
                self.versions = values if self.versions is None else self.versions & values
            else:
                yield f

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        out = []
        for folder in sorted(x.path for x in found if x.type == fs.FileType.Directory and x.base_name.startswith("endpoint=")):
            endpoint = folder.rpartition("endpoint=")[2]
            if self.endpoints is None or endpoint in self.endpoints:
                names = sorted(x.path for x in store.get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.File)
                out += [_Files(endpoint, names[at : at + FILES]) for at in range(0, len(names), FILES)]
        return out

    def read(self, partition: _Files):
        import pyarrow as pa

        store, _ = _store(self.path)
        text, rows = pa.string(), []
        kind = pa.schema([("key", text), ("endpoint", text), ("params", pa.map_(text, text)), ("projection_version", pa.int32()), ("fetched_at", text), ("response", text)])
        for name in partition.names if partition else ():
            with store.open_input_stream(name) as f:
                for line in f.read().splitlines():
                    entry = json.loads(line)
                    if self.versions is None or entry["projection_version"] in self.versions:
                        rows.append({"endpoint": partition.endpoint} | entry)
                    if len(rows) == ENTRIES:
                        yield pa.RecordBatch.from_pylist([r | {"params": [*(r["params"] or {}).items()]} for r in rows], kind)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([r | {"params": [*(r["params"] or {}).items()]} for r in rows], kind)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex
        store, root = _store(path)
        # made once, before any task: one that still runs when the others are aborted finds no folder to write to
        store.create_dir(self._staged(root), recursive=True)

    def _staged(self, root: str) -> str:
        return f"{root}/_staged-{self.run}"

    def write(self, batches) -> _Written:
        store, root = _store(self.path)
        lines: dict[str, list[str]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                endpoint = row.pop("endpoint")
                if not row["key"] or not endpoint or "/" in endpoint:
                    raise ValueError("an entry needs a key and the name of an endpoint")
                lines.setdefault(endpoint, []).append(json.dumps(row | {"params": dict(row["params"] or [])}, sort_keys=True))
        names = []
        for endpoint, found in lines.items():
            name = f"{uuid.uuid4().hex}.jsonl"
            with store.open_output_stream(f"{self._staged(root)}/{name}") as f:
                f.write("\n".join(found).encode())
            names.append((endpoint, name))
        return _Written(names)

    def commit(self, messages) -> None:
        store, root = _store(self.path)
        for endpoint, name in (x for m in messages if m for x in m.names):
            store.create_dir(f"{root}/endpoint={endpoint}", recursive=True)
            store.move(f"{self._staged(root)}/{name}", f"{root}/endpoint={endpoint}/{name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs

        store, root = _store(self.path)
        for _ in range(3):  # a task may have put a file there while the folder was being emptied
            if store.get_file_info(self._staged(root)).type != fs.FileType.Directory:
                return
            try:
                store.delete_dir(self._staged(root))
            except OSError:
                time.sleep(0.5)


class Responses(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("responses are only added")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with its filters."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Responses)
