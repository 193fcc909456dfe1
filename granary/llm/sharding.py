"""Sharding by vector bin packing: bytes, words and rows are balanced together, equal texts stay together.

Groups of equal texts fall into cells by their hash, so many to a shard that the driver only ever packs a
bounded number of items however large the corpus is. A group that is too large for a cell is cut into as
many items as it takes, which go to one shard together as long as any has room for them all.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut, word_count

SHARDS = 24
#: Cells to a shard. A group with more than a cell's share of all bytes, words or rows is packed by itself.
CELLS = 128
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
SIZES = ("bytes", "words", "rows")


def pack(items: np.ndarray, shards: int, groups: np.ndarray | None = None) -> np.ndarray:
    """The shard of every item (a vector of sizes, as shares of the totals).

    groups numbers the items; those of one number belong together, each by itself if there are none. Groups
    go from the largest to the smallest, each to the shard whose residual capacity has the highest dot
    product with it; of equal ones the first. A group of several items goes to such a shard among those
    with room for all of it; if there is none, its items go one by one, each as if by itself.
    """
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    out = np.zeros(len(items), np.int64)
    _, number = np.unique(np.arange(len(items)) if groups is None else groups, return_inverse=True)
    whole = np.zeros((number.max(initial=-1) + 1, items.shape[1]))
    np.add.at(whole, number, items)
    of = np.split(np.argsort(number, kind="stable"), np.cumsum(np.bincount(number))[:-1])
    for g in np.argsort(-whole.max(axis=1), kind="stable"):
        room = (residual >= whole[g] - 1e-12).all(axis=1)
        if len(of[g]) > 1 and room.any():
            out[of[g]] = np.argmax(np.where(room, residual @ whole[g], -np.inf))
            residual[out[of[g][0]]] -= whole[g]
            continue
        for i in of[g][np.argsort(-items[of[g]].max(axis=1), kind="stable")]:
            out[i] = np.argmax(residual @ items[i])
            residual[out[i]] -= items[i]
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot, words, item.

    size is the text's UTF-8 bytes plus ROW_BYTES; a null text is as an empty one. slot numbers a shard's
    rows from 0 without gaps: item after item, and within an item by doc_id, null first. Rows that repeat
    an id are rows of their own; an empty table gives no rows. Equal texts share a shard, unless their group
    is larger than the room (in bytes, words or rows) that larger groups left in every shard.

    The text is read once; what is kept of it has a few numbers a row. What the driver collects and sends
    back is bounded by shards * CELLS: as many cells, and items of large groups, each of which has more
    than half of a cell's share of some size.
    """
    spark, cells = docs.sparkSession, shards * CELLS
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        word_count(text).alias("words"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("g"),
    )
    rows = cut(rows)
    sums = [F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")]
    groups = rows.groupBy("g").agg(*sums)
    total = [float(x or 1) for x in groups.agg(*[F.sum(c) for c in SIZES]).first()]
    share = F.greatest(*[F.col(c) * (cells / t) for c, t in zip(SIZES, total)])
    large = groups.select("g", F.ceil(share).cast("int").alias("parts")).filter("parts > 1").orderBy("g").collect()
    starts = np.cumsum([cells] + [x["parts"] for x in large]).tolist()
    large = spark.createDataFrame([(bytes(x["g"]), x["parts"], s) for x, s in zip(large, starts)], "large_g binary, parts int, start long")

    rows = rows.join(F.broadcast(large), rows["g"] == F.col("large_g"), "left").drop("large_g")
    part = F.col("start") + F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("parts"))
    rows = rows.withColumn("item", F.coalesce(part, F.pmod(F.xxhash64("g"), F.lit(cells)))).drop("g", "start", "parts")

    packed = rows.groupBy("item").agg(*sums).orderBy("item").collect()
    sizes = np.array([[x[c] / t for c, t in zip(SIZES, total)] for x in packed], float).reshape(-1, len(SIZES))
    # items of one large group have numbers from its start on
    ids = np.array([x["item"] for x in packed], np.int64)
    groups = np.where(ids < cells, ids, cells + np.searchsorted(starts[:-1], ids, side="right"))
    shard_of, begin, lines = pack(sizes, shards, groups).tolist(), [0] * shards, []
    for x, shard in zip(packed, shard_of):
        lines.append((x["item"], shard, begin[shard]))
        begin[shard] += x["rows"]
    lines = spark.createDataFrame(lines, "item long, shard int, begin long")

    slot = F.col("begin") + F.row_number().over(Window.partitionBy("item").orderBy("doc_id", "text_crc32")) - 1
    return rows.join(F.broadcast(lines), "item").select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), "words", "item")


def shard_law(docs: DataFrame) -> DataFrame:
    """The rows of shard_documents with the law that holds: bytes, sizes near equal."""
    out = shard_documents(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "words", "item")
