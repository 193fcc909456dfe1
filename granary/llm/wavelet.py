"""Token ids in files of wavelet matrices: bit planes with rank directories, one matrix to a shard.

Plane k holds bit k, from the highest, of every token, in the order that a stable sort by the bits above
leaves. Access, counting and search for occurrences walk down the planes with one rank each. A file of the
format is a Parquet file (zstd) with one row, the shard, so that Spark's readers and writers, their commit
protocol and column pruning apply: counts and places of documents are read without the planes.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut, drop_folder, sent, shared_folder
from granary.llm.pieces import PieceEncoder

#: Tokens at which a shard is closed, and bits that one entry of a rank directory covers.
SHARD_TOKENS, RANK_BITS = 2_000_000, 512
END_ID = 0
#: Pieces that a worker remembers, and bytes that it cuts at once.
KNOWN_PIECES, PART_BYTES = 900_000, 16_000_000
FILE = "part int, seq int, n_tokens long, zeros array<long>, planes array<binary>, ranks array<binary>, doc_ids array<long>, ends array<long>"
#: The columns of FILE that make a matrix.
MATRIX = ["part", "seq", "n_tokens", "zeros", "planes", "ranks"]


class WaveletMatrix:
    """A sequence of ids below 2 ** len(planes)."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n, zeros, planes, ranks = len(ids), [], [], []
        for k in range(bits - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << k)) != 0
            packed = np.packbits(ones, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (RANK_BITS // 8)))
            counts = np.bitwise_count(packed.view(np.uint64)).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))
            left = np.compress(~ones, ids)
            zeros.append(len(left))
            ids = np.concatenate([left, np.compress(ones, ids)])
        return cls(n, zeros, planes, ranks)

    def rank(self, plane: int, at: int) -> int:
        """Number of ones before a place of a plane."""
        block = at // RANK_BITS
        begin, end = block * (RANK_BITS // 8), at // 8
        count = int(self.ranks[plane][block]) + int(np.bitwise_count(self.planes[plane][begin:end]).sum())
        return count + (int(self.planes[plane][end]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else count

    def _down(self, plane: int, at: int, one: int) -> int:
        ones = self.rank(plane, at)
        return self.zeros[plane] + ones if one else at - ones

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for k, plane in enumerate(self.planes):
            one = int(plane[at // 8]) >> at % 8 & 1
            value, at = value << 1 | one, self._down(k, at, one)
        return value

    def count(self, value: int, begin: int = 0, end: int | None = None) -> int:
        """How often an id is between two places."""
        first, last = self._range(value, begin, self.n if end is None else end)
        return last - first

    def _range(self, value: int, begin: int, end: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            one = value >> (len(self.planes) - 1 - k) & 1
            begin, end = self._down(k, begin, one), self._down(k, end, one)
        return begin, end

    def occurrence(self, value: int, nth: int) -> int:
        """The place of the nth (from 0) of an id; -1 if there are fewer."""
        first, last = self._range(value, 0, self.n)
        if nth >= last - first:
            return -1
        at = first + nth
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - k) & 1
            at = self._select(k, at - self.zeros[k] if one else at, one)
        return at

    def _select(self, plane: int, nth: int, one: int) -> int:
        """The place of the nth (from 0) one or zero of a plane."""
        directory = self.ranks[plane].astype(np.int64)
        if not one:
            directory = np.arange(len(directory)) * RANK_BITS - directory
        block = int(np.searchsorted(directory, nth, side="right")) - 1
        begin = block * (RANK_BITS // 8)
        found = np.unpackbits(self.planes[plane][begin : begin + RANK_BITS // 8], bitorder="little") == one
        return block * RANK_BITS + int(np.flatnonzero(found)[nth - int(directory[block])])

    def all(self) -> np.ndarray:
        """All ids in order, from the lowest plane up: each plane merges what the one below left sorted by its bit."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(out)
            above[np.flatnonzero(~ones)] = out[: self.zeros[k]]
            above[np.flatnonzero(ones)] = out[self.zeros[k] :] | kind(1 << (len(self.planes) - 1 - k))
            out = above
        return out.astype(np.uint32)

    @classmethod
    def of_row(cls, row: dict) -> WaveletMatrix:
        return cls(row["n_tokens"], row["zeros"], [np.frombuffer(x, np.uint8) for x in row["planes"]], [np.frombuffer(x, "<u4") for x in row["ranks"]])


class Encoder:
    """Encodes texts as the library does without special tokens. Byte-level vocabularies go by distinct pieces, others text by text.

    A text that holds one of the vocabulary's added tokens goes through the library as a whole, which finds them first.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.bits = max(self.library.get_vocab_size() - 1, 1).bit_length()
        settings = json.loads(content)
        self.added = [x["content"] for x in settings.get("added_tokens") or []]
        first = settings["pre_tokenizer"] or {}
        plain = settings["normalizer"] is None and settings.get("truncation") is None and not any(x.get("normalized") or x.get("lstrip") or x.get("rstrip") for x in settings.get("added_tokens") or [])
        by_piece = plain and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        self.pieces = PieceEncoder(self._encode_pieces, most=KNOWN_PIECES, part_bytes=PART_BYTES) if by_piece else None

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))

    def _whole(self, text: str | None) -> np.ndarray:
        return np.array(self.library.encode(text or "", add_special_tokens=False).ids, np.uint32)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow array of texts (null: empty), and the place where each text's ids end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.pieces:
            apart = np.ones(len(texts), bool)
        else:
            apart = np.zeros(len(texts), bool)
            for token in self.added:
                apart |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        if not apart.any():
            return self.pieces.encode(texts)
        rest = np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        if not apart.all():
            rest = self.pieces.encode(pc.if_else(pa.array(apart), pa.scalar("", texts.type), texts))
        begins = np.concatenate([[0], rest[1][:-1]])
        parts = [self._whole(texts[k].as_py()) if apart[k] else rest[0][begins[k] : rest[1][k]] for k in range(len(texts))]
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])


_encoders: dict[str, Encoder] = {}


def encoder(content: str) -> Encoder:
    """The encoder of a vocabulary file's content, built once in each process."""
    if content not in _encoders:
        _encoders[content] = Encoder(content)
    return _encoders[content]


def _ended(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids with END_ID behind each text's, and the new ends."""
    after = ends + np.arange(1, len(ends) + 1)
    out = np.full(len(ids) + len(ends), END_ID, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[after - 1] = False
    out[np.flatnonzero(inside)] = ids
    return out, after


def _shards(batches, content, shard_tokens):
    """One row of FILE for each shard of a partition, whose rows come in ascending doc_id order."""
    import pyarrow as pa
    from pyspark import TaskContext

    made = encoder(content.value)
    kind = np.uint16 if made.bits <= 16 else np.uint32
    part, seq, n, doc_ids, sizes, ids = TaskContext.get().partitionId(), 0, 0, [], [], []
    names = [x.split()[0] for x in FILE.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def closed():
        m = WaveletMatrix.build(np.concatenate(ids), made.bits)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (pa.concat_arrays(doc_ids), pa.array(np.cumsum(np.concatenate(sizes))))]
        row = part, seq, n, m.zeros, [x.tobytes() for x in m.planes], [x.tobytes() for x in m.ranks]
        return pa.RecordBatch.from_arrays([*[pa.array([x], k) for x, k in zip(row, kinds)], *lists], names)

    for batch in batches:
        found, ends = _ended(*made.encode(batch.column(1)))
        found, lengths, at, done = found.astype(kind), np.diff(ends, prepend=0), 0, 0
        while at < len(ends):
            # up to the document that fills the shard
            upto = min(int(np.searchsorted(ends, done + shard_tokens - n)) + 1, len(ends))
            doc_ids.append(batch.column(0).slice(at, upto - at))
            sizes.append(lengths[at:upto])
            ids.append(found[done : ends[upto - 1]])
            n, at, done = n + len(ids[-1]), upto, int(ends[upto - 1])
            if n >= shard_tokens:
                yield closed()
                seq, n, doc_ids, sizes, ids = seq + 1, 0, [], [], []
    if doc_ids:
        yield closed()


def write_tokens(docs: DataFrame, path: str, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes every whole text (null: empty), appends END_ID to each and writes the shards in ascending doc_id order.

    Partitions are ranges of doc_id; a shard is closed at shard_tokens, whatever its partition holds.
    Rows that repeat an id follow each other by their text; null ids come first.
    """
    with open(vocabulary_path, encoding="utf-8") as f:  # of fixed size; read once on the driver
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = rows.mapInArrow(lambda batches: _shards(batches, content, shard_tokens), FILE)
    shards.write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def read_tokens(spark, path: str, finish=None, columns: str = "ids binary") -> DataFrame:
    """part, seq, nth, doc_id, first, n_tokens of every document in the files, and what finish makes of its ids.

    finish takes a document's ids (a NumPy array of unsigned 32-bit integers); by default they are
    returned as bytes. first is the place of the document's first id in its shard. A folder without files gives no rows.
    """
    import pyarrow as pa

    finish = finish or (lambda ids: ids.astype("<u4").tobytes())
    kind = {"long": pa.int64(), "binary": pa.binary()}[columns.split()[1]]

    def run(batches):
        for batch in batches:
            for k, row in enumerate(batch.select(MATRIX).to_pylist()):
                ids = WaveletMatrix.of_row(row).all()
                doc_ids, ends = (batch.column(c)[k].values for c in ("doc_ids", "ends"))
                ends = ends.to_numpy()
                begins = np.concatenate([[0], ends[:-1]])
                made = pa.array([finish(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())], kind)
                n = len(doc_ids)
                head = [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), pa.array(np.arange(n))]
                yield pa.RecordBatch.from_arrays([*head, doc_ids, pa.array(begins), pa.array(ends - begins), made], ["part", "seq", "nth", "doc_id", "first", "n_tokens", columns.split()[0]])

    return spark.read.schema(FILE).parquet(path).mapInArrow(run, f"part int, seq int, nth long, doc_id long, first long, n_tokens long, {columns}")


def shard_starts(spark, path: str) -> DataFrame:
    """part, seq and before, the number of ids in all shards before: added up within parts, and over the parts' totals."""
    sizes = spark.read.schema(FILE).parquet(path).select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    parts = parts.select(F.col("part").alias("of_part"), (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("before_part"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return sizes.withColumn("within", within).join(parts, F.col("part") == F.col("of_part")).select("part", "seq", (F.col("before_part") + F.col("within")).alias("before"))


def token_index(spark, path: str, finish=None, columns: str = "ids binary") -> DataFrame:
    """read_tokens with start: the number of ids of all documents before. A folder without files gives no rows."""
    rows = read_tokens(spark, path, finish, columns).join(sent(shard_starts(spark, path)), ["part", "seq"])
    return rows.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", columns.split()[0])


def id_counts(spark, path: str, ids: list[int]) -> DataFrame:
    """id and n: how often each of a few ids is in the files, by two ranks a plane and shard; 0 for an id that isn't there. A folder without files gives no rows."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                m = WaveletMatrix.of_row(row)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([m.count(x) for x in ids], pa.int64())], ["id", "n"])

    return spark.read.schema(FILE).parquet(path).select(MATRIX).mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def occurrences(spark, path: str, value: int) -> DataFrame:
    """doc_id and at (from 0, in the document) of every place of an id, found by selects in each shard."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for k, row in enumerate(batch.select(MATRIX).to_pylist()):
                m = WaveletMatrix.of_row(row)
                doc_ids, ends = (batch.column(c)[k].values for c in ("doc_ids", "ends"))
                ends = ends.to_numpy()
                places = np.array([m.occurrence(value, i) for i in range(m.count(value))], np.int64)
                of = np.searchsorted(ends, places, side="right")
                yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array(of)), pa.array(places - np.concatenate([[0], ends])[of])], ["doc_id", "at"])

    return spark.read.schema(FILE).parquet(path).mapInArrow(run, "doc_id long, at long")


def round_trip(docs: DataFrame, vocabulary_path: str, **how) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, as read back from written files, which go afterwards."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    try:
        write_tokens(docs, path, vocabulary_path, **how)
        return cut(token_index(spark, path, lambda ids: zlib.crc32(ids.astype("<u4", copy=False)), "ids_crc32 long"))
    finally:
        drop_folder(spark, path)
