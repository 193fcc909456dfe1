"""Near-duplicate detection: one-permutation MinHash with optimal densification, bands, star-shaped candidates.

A text's 5-word shingles are hashed once; the hash's high bits name a bin and the least hash in a bin is
its value. An empty bin takes the value of a bin picked by a hash of its own number, tried again until it
is filled. Texts that agree in a band of bins share a bucket, and in a bucket only a hub is compared with
the others, so candidates grow with a bucket's size and not with its square. Links are confirmed on the
full shingle sets. Buckets whose members are still in different components get some more hubs, without the
one before. What is still divided then is compared exactly: two sets of different
components that are similar enough share one of their rarest shingles, early in the order of rarity.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut, cut_few, cut_texts, keep_rows, sent, spread, text_key
from granary.llm.components import components
from granary.llm.words import mixed, windows, word_hashes

WORDS, PERCENT = 5, 75
#: 42 bands of 6 bins: texts of similarity 0.75 share no bucket with a chance of 0.0003.
BINS, BAND = 256, 6
BANDS = BINS // BAND
#: Shingles that go from Python to Spark at once.
SENT_SHINGLES = 500_000
#: Hubs of each bucket that is divided, round by round, before the rest is compared exactly.
HUBS = (1, 4)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as ascending 64-bit hashes.

    Letters A-Z are lower-cased and words are what stands between space, tab and line characters. With
    fewer than WORDS words the whole sequence is one shingle; without words there is none.
    """
    words = text.encode().lower().split() if text else []
    return np.unique(windows(word_hashes(words), min(WORDS, len(words)))) if words else np.empty(0, np.uint64)


@cache
def _donors() -> np.ndarray:
    """For every try and bin, the bin to take a value from."""
    grid = np.arange(8 * BINS * BINS, dtype=np.uint64).reshape(-1, BINS)
    return (mixed(grid + np.uint64(0x51ED270B)) >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """BINS minima of a non-empty set of ascending hashes, densified."""
    bins = (shingles >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
    first = np.searchsorted(bins, np.arange(BINS))
    full = np.zeros(BINS, bool)
    full[bins] = True
    out = shingles[np.minimum(first, len(shingles) - 1)]
    empty, donors, own = np.flatnonzero(~full), _donors(), out.copy()
    for k in range(len(donors)):
        if not len(empty):
            return out
        donor = donors[k, empty]
        given = full[donor]
        out[empty[given]] = own[donor[given]]
        empty = empty[~given]
    # next to impossible: what is left takes the value of the least full bin
    out[empty] = own[bins[0]]
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = minima[: BANDS * BAND].reshape(BANDS, BAND)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(BAND):
        total = mixed(total ^ rows[:, k])
    return total


def _digest(found: np.ndarray) -> tuple[int, int]:
    first, second = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64).tolist()
    return first, second


def _signed(texts: DataFrame) -> DataFrame:
    """doc_id, own, n_shingles, the set's 128-bit digest (h1, h2) and band keys; null where there is no shingle."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                found = shingle_set(text)
                rows.append((len(found), *_digest(found), band_keys(signature(found)).view(np.int64)) if len(found) else (0, None, None, None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(x, kind) for x, kind in zip(list(zip(*rows)) or [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "own", "n_shingles", "h1", "h2", "bands"])

    return texts.mapInArrow(run, "doc_id long, own long, n_shingles long, h1 long, h2 long, bands array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """The digest of each text's shingle set and the set as an array, for texts that have any."""
    import pyarrow as pa

    def made(found):
        columns = [pa.array(x, pa.int64()) for x in zip(*map(_digest, found))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["h1", "h2", "shingles"])

    def run(batches):
        for batch in batches:
            found, n = [], 0
            for shingles in map(shingle_set, batch.column(2).to_pylist()):
                if len(shingles):
                    found.append(shingles)
                    n += len(shingles)
                if n >= SENT_SHINGLES:  # sets are larger than their texts
                    yield made(found)
                    found, n = [], 0
            if found:
                yield made(found)

    return texts.mapInArrow(run, "h1 long, h2 long, shingles array<long>")


def _linked(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    left, right = (sets.select(F.col("id").alias(f"{x}_id"), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    both = edges.join(left, F.col("a") == F.col("a_id")).join(right, F.col("b") == F.col("b_id"))
    same = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter(100 * same >= PERCENT * (F.size("a_set") + F.size("b_set") - same)).select("a", "b")


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """bucket, node, n, label: the members with the least node of their component."""
    if roots is None:
        return members.withColumn("label", F.col("node"))
    moved = roots.select(F.col("node").alias("moved"), "root")
    return members.join(moved, F.col("node") == F.col("moved"), "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("label"))


def _rest(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) between different labels: all that can be links among the nodes of divided buckets.

    A set's shingles are ordered by the number of these nodes that have them. If two sets are similar enough, so
    many must be shared that the first shared one has as many at and after its place in both: this bounds its
    place in each set, and each pair by its two places. A shingle's commonest label is never met with itself,
    so a component that already holds most of a group is compared with the others only.
    """
    divided = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
    nodes = cut_few(labelled.join(divided, "bucket").select("node", "label").distinct())
    if nodes.isEmpty():
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    sized = sets.select("id", F.size("shingles").alias("n"), "shingles")  # the explosion below carries numbers, no arrays
    own = sized.join(nodes, F.col("id") == F.col("node")).select("node", "label", "n", F.explode("shingles").alias("shingle"))
    common = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").withColumnRenamed("shingle", "s")
    # shingles of one set only come first and meet nothing
    ranked = own.join(common, F.col("shingle") == F.col("s"), "left").withColumn("df", F.coalesce("df", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "shingle")) - 1
    early = ranked.withColumn("left", F.col("n") - place).filter(f"df > 1 AND 100 * left >= {PERCENT} * n")
    early = cut(early.select("shingle", "node", "label", "n", "left"))
    counts = early.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("rows"))
    major = counts.groupBy("shingle").agg(F.max_by("label", F.struct("rows", "label")).alias("major"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    major = cut_few(major.withColumnRenamed("shingle", "s"))  # both sides of the join come straight from a shuffle, which the skew join can split
    early = cut(early.join(major, F.col("shingle") == F.col("s")).select("shingle", "node", "label", "n", "left", "major"))
    minor = early.filter("label <> major").select(F.col("shingle").alias("s"), F.col("node").alias("a"), F.col("label").alias("a_label"), F.col("n").alias("a_n"), F.col("left").alias("a_left"))
    may = f"shingle = s AND label <> a_label AND {100 + PERCENT} * least(left, a_left) >= {PERCENT} * (n + a_n)"
    pairs = minor.join(early, F.expr(may))
    return cut_few(pairs.select(F.least("node", "a").alias("a"), F.greatest("node", "a").alias("b")).distinct())


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, own (the text's key), n_shingles, class_id, component_id and group, a number for each component, null for texts without shingles."""
    text = F.col(text_col).cast("string")
    texts = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("own"), text.alias("text")))
    signed = cut_texts(_signed(texts))
    classes = signed.filter("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id"), F.any_value("n_shingles").cast("int").alias("n"), F.any_value("bands").alias("bands"))
    # a class's number; ids may be null or stand for several texts
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))

    members = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("bucket")
    members = cut(members.join(shared, "bucket").select("bucket", "node", "n"))
    nodes = cut_few(members.select(F.col("node").alias("of")).distinct().join(classes, F.col("of") == F.col("node")).select("node", "class_id", F.col("h1").alias("k1"), F.col("h2").alias("k2")))
    wanted = sent(nodes.select("class_id").distinct())
    sets = _sets(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("class_id")), "left_semi")).groupBy("h1", "h2").agg(F.any_value("shingles").alias("shingles"))
    sets = cut_texts(sets.join(nodes, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).select(F.col("node").alias("id"), "shingles"))

    roots = None
    for k, many in enumerate(HUBS):
        labelled = _labelled(members, roots)
        # a hub goes by a hash that differs between buckets and rounds
        hub = [F.min_by(F.struct("node", "label", "n"), F.xxhash64("node", "bucket", F.lit(k), F.lit(j))) for j in range(many)]
        hubs = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.array_distinct(F.array(*hub)).alias("hubs"))
        live = cut(labelled.join(hubs.filter("low < high").select("bucket", "hubs"), "bucket"))
        # hubs have met their whole bucket and needn't come back; whole buckets end once they aren't divided
        members = live.filter(~F.exists("hubs", lambda h: h["node"] == F.col("node"))).select("bucket", "node", "n")
        met = live.select("node", "label", "n", F.explode("hubs").alias("h")).filter(f"label <> h.label AND 100 * least(n, h.n) >= {PERCENT} * greatest(n, h.n)")
        edges = met.select(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()
        links = cut(_linked(edges, sets))
        if roots is None:
            roots = components(links)
        elif not links.isEmpty():
            roots = components(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    links = cut(_linked(_rest(_labelled(members, roots), sets), sets))
    if not links.isEmpty():
        roots = components(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    grouped = classes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("h1", "h2", "class_id", F.coalesce("root", "node").alias("group"))
    least = grouped.groupBy(F.col("group").alias("of")).agg(F.min("class_id").alias("component_id"))
    grouped = grouped.join(least, F.col("group") == F.col("of")).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "class_id", "component_id", "group")
    out = signed.drop("bands").join(grouped, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    lone = F.col("group").isNull()
    own_id = lambda c: F.when(lone, F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select("doc_id", "own", "n_shingles", own_id("class_id"), own_id("component_id"), "group")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, class_id.

    component_id is the smallest id reachable over links of similarity PERCENT or more, kept tells whether
    that is the row's own. Of two texts that share a bucket no link is missed. class_id is the smallest id with the same shingle set; sets are compared once
    per class. A null, empty or blank text has no shingles and is linked with nothing. Rows that repeat an
    id are linked by their own texts. Rows with a null id are linked as others are; component_id is null only if no row
    of the component has an id. Other columns are not read; an empty table gives no rows.
    """
    out = _judged(docs, id_col, text_col)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One input row of every component, the one with the smallest id (null last, of equal ids by the text's key), with the input's columns.

    All texts without shingles stay, except for rows that repeat an id together with its text.
    """
    judged = cut(_judged(docs, id_col, text_col))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "own"))
    best = judged.filter(F.col("group").isNotNull()).groupBy(F.col("group").alias("of")).agg(first.alias("best"))
    rows = judged.join(best, F.col("group") == F.col("of"), "left")
    stays = F.col("group").isNull() | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("own") == F.col("best.own")))
    return keep_rows(docs, rows.select("doc_id", "own", stays.alias("kept")), id_col, text_col)
