"""Byte-level BPE in time linear in the text: longest matches, backtracking over compatible neighbours.

A token sequence is what the merge loop would give exactly when each pair of neighbours is, by itself,
what the loop gives for their joined bytes. The encoder walks from left to right, tries the longest
token first and steps back where no token fits; a position that failed is not tried again.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.common import spread
from granary.llm.pieces import PieceEncoder, give_back, parts_of

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
PAIRS_KEPT = 100_000
#: Ids that are decoded at once.
DECODED_IDS = 2_000_000


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The ranks of a rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


class ByteBPE:
    """Encodes single pieces by ranks; a rank is the token's id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        # lists by rank, and pairs as one number: a worker keeps these tables as long as it lives
        bytes_of = {rank: token for token, rank in ranks.items()}
        self.n = max(bytes_of, default=-1) + 1
        self.tokens = pa.array([bytes_of.get(k) for k in range(self.n)], pa.large_binary())
        self.size = [len(bytes_of.get(k, b"")) for k in range(self.n)]
        self.first: list[int | None] = [None] * self.n
        self.second: list[int | None] = [None] * self.n
        self.shorter: list[int | None] = [None] * self.n
        self.joined: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        merged = [token for token in ranks if len(token) == 1]
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = self._merge(token, rank)
                if len(parts) != 2:
                    continue  # no merge makes it; it is used only when it is a whole piece
                self.first[rank], self.second[rank] = ranks[parts[0]], ranks[parts[1]]
                self.joined[self.first[rank] * self.n + self.second[rank]] = rank
                merged.append(token)
        made = {*merged}
        for token in merged:
            self.machine.add_word(token.decode("latin-1"), ranks[token])
            cut = next((n for n in range(len(token) - 1, 0, -1) if token[:n] in made), 0)
            self.shorter[ranks[token]] = ranks[token[:cut]] if cut else None
        self.machine.make_automaton()

    def _merge(self, token: bytes, below: int) -> list[bytes]:
        """What the merge loop makes of a token's bytes with ranks under its own."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merge loop leaves a border between these two tokens.

        Takes the merges back, latest first, following the two tokens that touch at the border: had their
        own merge come before the one just taken back, it would have crossed the border. Of equal ranks
        the leftmost merge comes first, so one equal to the right token's rank crosses as well.
        """
        a, b, limit = left, right, float("inf")
        while True:
            crossing = self.joined.get(a * self.n + b)
            if crossing is not None and crossing < limit:
                return False
            after, before = self.second[a], self.first[b]
            if after is not None and (before is None or a > b):
                limit, a = a, after
            elif before is not None:
                limit, b = b + 1, before
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left * self.n + right
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= PAIRS_KEPT:
                self.fits.clear()
            known = self.fits[pair] = self._compatible(left, right)
        return known

    def encode_bytes(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest: list[int | None] = [None] * (n + 1)
        sizes = self.size
        for end, rank in self.machine.iter(piece.decode("latin-1")):
            longest[end - sizes[rank] + 1] = rank  # of the matches from one place the longest ends last
        open_at, ids, at = bytearray(b"\1") * (n + 1), [], 0
        token = longest[0]
        while at < n:
            last = ids[-1] if ids else None
            while token is not None:
                end = at + sizes[token]
                if open_at[end] and (last is None or self.compatible(last, token)):
                    break
                token = self.shorter[token]
            if token is None:
                open_at[at] = 0
                token = ids.pop()
                at -= sizes[token]
            else:
                ids.append(token)
                at, token = end, longest[end]
        return ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in one array, and how many each has."""
        found = [self.encode_bytes(x.encode()) for x in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def decode(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The joined bytes of ids, and where each id's bytes end in them."""
        joined = self.tokens.take(pa.array(ids))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        return memoryview(joined.buffers()[2] or b"")[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


_built: dict[bytes, tuple[ByteBPE, PieceEncoder]] = {}


def encoder(content: bytes, pattern: str) -> tuple[ByteBPE, PieceEncoder]:
    """The encoder of a rank file's content, built once in each process."""
    key = hashlib.sha256(content + pattern.encode()).digest()
    if key not in _built:
        bpe = ByteBPE(read_ranks(content))
        _built[key] = bpe, PieceEncoder(bpe.encode_pieces, pattern)
    return _built[key]


def _run(batches, content, pattern, finish, schema):
    bpe, texts = encoder(content.value, pattern)
    for batch in (part for whole in batches for part in parts_of(whole, 1)):
        columns = finish(bpe, *texts.encode(batch.column(1)))
        give_back()
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, type=f.type) for x, f in zip(columns, schema)]], ["doc_id", *schema.names])


def _whole(bpe: ByteBPE, ids: np.ndarray, ends: np.ndarray):
    packed, begins = ids.astype("<u4", copy=False).tobytes(), np.concatenate([[0], ends[:-1]])
    return ([packed[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())],)


def _digests(bpe: ByteBPE, ids: np.ndarray, ends: np.ndarray):
    packed, begins = memoryview(ids.astype("<u4", copy=False)).cast("B"), np.concatenate([[0], ends[:-1]])
    of_ids = [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(begins.tolist(), ends.tolist())]
    of_text = []
    # texts are decoded some at a time, as long as they have so many ids together
    at = 0
    while at < len(ends):
        upto = max(int(np.searchsorted(ends, begins[at] + DECODED_IDS, side="right")), at + 1)
        data, places = bpe.decode(ids[begins[at] : ends[upto - 1]])
        places = np.concatenate([[0], places])[np.concatenate([[0], ends[at:upto] - begins[at]])].tolist()
        of_text += [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(places[:-1], places[1:])]
        at = upto
    return ends - begins, of_ids, of_text


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers in one binary) of every row, in the input's partitions.

    Every match of the pattern in the whole text is encoded by itself, without special tokens; a null or
    empty text has no ids. Repeated rows and ids give as many rows; other columns are not read.
    """
    return _encoded(docs, rank_path, pattern, id_col, text_col, _whole, "doc_id long, ids binary")


def encode_and_decode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every row: encodes as encode_documents does and decodes the ids again."""
    return _encoded(docs, rank_path, pattern, id_col, text_col, _digests, SCHEMA)


def _encoded(docs, rank_path, pattern, id_col, text_col, finish, schema):
    spark = docs.sparkSession
    with open(rank_path, "rb") as f:  # the vocabulary, of fixed size, is read once on the driver and sent to the executors
        content = spark.sparkContext.broadcast(f.read())
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", ")[1:])])
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return spread(picked).mapInArrow(lambda batches: _run(batches, content, pattern, finish, arrow), schema)
