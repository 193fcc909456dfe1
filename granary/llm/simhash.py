"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits, each a word of the binary Golay code [23, 12] with
leading zeros. Every word lies within 3 bits of exactly one codeword, so a word has an index of 12 bits. A segment's keys are
the indices of the word itself and of all words one bit away, six at most: words that differ in two bits or fewer
share one, as the word between them belongs to both. Three differing bits leave, by the pigeonhole principle,

* a segment without any, and of it and the one after it (cyclically) another within two bits: if the next
  segment has all three, the one before the clean one is clean as well, and the clean one is its next; or
* one in each segment: then the first shares an index, and one half of either other segment is clean.

Fingerprints that share a key (33 bits at least) are compared. A bucket gives a spanning forest of its links, not
its pairs. Fingerprints of crowded buckets meet at words between them instead: of two that differ in three bits
or fewer, some word is one bit from the one and two from the other at most, and everything around a word
that has a fingerprint within one bit is linked to that.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import cut, cut_few, cut_texts, sent, spread
from granary.llm.components import components

WORDS, SEED, MOST_BITS = 3, 42, 3
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: The code's generator polynomial, a fixed value.
GENERATOR = 0b110001110101
#: Fingerprints in a bucket from which it counts as crowded: comparing costs its square, meeting between costs 2081 rows a fingerprint.
CROWDED = 256


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in more than half of the shingles' hashes; 0 for a text without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    flat, width = b" ".join(words), min(WORDS, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
    hashes = np.fromiter([xxhash.xxh64_intdigest(flat[a:b], SEED) for a, b in zip(begins.tolist(), ends[width - 1 :].tolist())], "<u8", len(begins))
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):  # eight bytes of a hash become 64
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@cache
def _corrections() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each single bit by the generator, and for every remainder the error of up to three bits that has it."""
    rest = np.zeros(23, np.int64)
    for i in range(23):
        rest[i] = 1 << i
        for k in range(i, 10, -1):
            if rest[i] >> k & 1:
                rest[i] ^= GENERATOR << (k - 11)
    error = np.zeros(2048, np.int64)
    for n in (1, 2, 3):
        for bits in combinations(range(23), n):
            error[np.bitwise_xor.reduce(rest[list(bits)])] = sum(1 << i for i in bits)
    return rest, error


def index(words: np.ndarray) -> np.ndarray:
    """The number, 12 bits, of the codeword nearest to each word of 23 bits."""
    rest, error = _corrections()
    found = np.zeros(words.shape, np.int64)
    for i in range(23):
        found ^= (words >> i & 1) * rest[i]
    return (words ^ error[found]) >> 11


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For fingerprints (unsigned), how many keys each has and all keys, those of one together. Fingerprints MOST_BITS apart share a key."""
    parts = [(prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64) for first, width in SEGMENTS]
    near = []
    for part, (_, width) in zip(parts, SEGMENTS):
        found = np.sort(index(part[:, None] ^ np.array([0] + [1 << i for i in range(width)])), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        near.append(found)
    columns = []
    for k in range(3):
        fuzzy = near[(k + 1) % 3]
        columns.append(np.where(fuzzy < 0, -1, k << 60 | parts[k][:, None] << 12 | fuzzy))
    halves = [(part & 1023, part >> 10) for part in parts[1:]]
    for x in (0, 1):
        for y in (0, 1):
            exact = halves[0][x] << 11 | halves[1][y]
            columns.append(np.where(near[0] < 0, -1, 3 + 2 * x + y << 60 | exact[:, None] << 12 | near[0]))
    keys = np.concatenate(columns, axis=1)
    return (keys >= 0).sum(axis=1), keys[keys >= 0]


def forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what links of the members connect, one less than members at most."""
    apart = np.bitwise_count(members[:, None] ^ members[None, :])
    left, out = np.ones(len(members), bool), []
    while left.any():
        new = np.array([np.argmax(left)])
        left[new] = False
        while len(new):
            met = (apart[new] <= MOST_BITS) & left[None, :]
            reached = np.flatnonzero(met.any(axis=0))
            out += zip(members[new[met[:, reached].argmax(axis=0)]].tolist(), members[reached].tolist())
            left[reached] = False
            new = reached
    return out


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and print, the fingerprint as a signed number."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            found = np.fromiter(map(fingerprint, batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return spread(texts).mapInArrow(run, "doc_id long, print long")


def _keyed(prints: DataFrame) -> DataFrame:
    """key, print: all keys of the fingerprints."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                many, keys = bucket_keys(part.column(0).to_numpy().view(np.uint64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(keys))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["print", "keys"])

    return prints.mapInArrow(run, "print long, keys array<long>").select(F.explode("keys").alias("key"), "print")


def _forests(buckets: DataFrame) -> DataFrame:
    """Edges (a, b) of the spanning forests of buckets; buckets has arrays of fingerprints."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            edges = [edge for members in batch.column(0).to_pylist() for edge in forest(np.array(members, np.int64).view(np.uint64))]
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long").distinct()


def _between(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints with links, without comparing any two: one row for each word within two bits of one."""
    flip = lambda x, i: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    one = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: flip(F.col("print"), i))
    two = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(63)), lambda i: F.transform(F.sequence(F.lit(0), i - 1), lambda j: flip(flip(F.col("print"), i), j))))
    close = prints.select("print", F.explode(F.concat(F.array("print"), one)).alias("word"))
    hubs = cut(close.groupBy("word").agg(F.min("print").alias("hub")).withColumnRenamed("word", "at"))
    around = close.union(prints.select("print", F.explode(two).alias("word")))
    return around.join(hubs, F.col("word") == F.col("at")).filter("print <> hub").select(F.col("print").alias("a"), F.col("hub").alias("b")).distinct()


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id, class_id.

    fingerprint is the SimHash of the text's WORDS-word shingles, repeats included, as 16 hexadecimal digits. class_id is
    the smallest id with the same fingerprint, component_id the smallest one reachable over links of MOST_BITS
    differing bits or fewer. Null, empty and blank texts have fingerprint zero and are linked as any others. Rows that repeat an
    id, or have none, are linked by their own texts; an id is null in a result only if no row of the class or
    component has one. Other columns are not read; an empty table gives no rows.

    Equal fingerprints are one class before anything is compared, so copies cost nothing. Keys leave their
    fingerprint as a number; keys of one fingerprint only end in a count that is combined before its shuffle. No
    bucket of more than crowded fingerprints is ever gathered.
    """
    prints = cut_texts(_prints(docs, id_col, text_col))
    classes = cut(prints.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")))
    keyed = _keyed(classes.select("print"))
    shared = sent(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumnRenamed("key", "at"))
    members = cut(keyed.join(shared, F.col("key") == F.col("at")).select("key", "print", "size"))
    edges = _forests(members.filter(F.col("size") <= crowded).groupBy("key").agg(F.collect_list("print").alias("prints")).select("prints"))
    busy = cut_few(members.filter(F.col("size") > crowded).select("print").distinct())
    if not busy.isEmpty():
        edges = edges.union(_between(busy))
    roots = components(cut(edges))

    grouped = classes.join(roots, F.col("print") == F.col("node"), "left").withColumn("root", F.coalesce("root", "print"))
    least = grouped.groupBy(F.col("root").alias("of")).agg(F.min("class_id").alias("component_id"), F.count(F.lit(1)).alias("many"))
    # a fingerprint of one row without links needs no lookup
    known = grouped.join(least, F.col("root") == F.col("of")).filter("n > 1 OR many > 1").select(F.col("print").alias("known"), "class_id", "component_id")
    known = sent(known)
    out = prints.join(known, F.col("print") == F.col("known"), "left")
    own = lambda c: F.when(F.col("known").isNull(), F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), own("component_id"), own("class_id"))
