"""Exact deduplication: group by a 128-bit content hash, then compare bytes inside the groups. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common
from granary.llm.common import cut, join_known, keep_rows, text_key, without_spaces

#: Tasks among which the texts of one hash are dealt where hashes are too many to be sent.
SALTS = 16


def _preference():
    """Orders equal texts: most code points first, then the smallest id, null ids last; rows that repeat an id by their text's key."""
    return F.struct((-F.col("n_code")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("own"))


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, own (the text's key), keep_id, group_size, stays (whether the row, and not its id, is the one that stays), text_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_code"), text_key(text).alias("own"), without_spaces(text).alias("norm"))
    hashed = whole.withColumn("h", F.unhex(F.md5("norm")))
    keys = cut(hashed.select("doc_id", "n_code", "own", "h", F.sha2("norm", 256).alias("text_sha256")))
    groups = keys.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min(_preference()).alias("best"))
    repeated = cut(groups.filter("size > 1").select("h", "size", F.col("best.doc_id").alias("best_id"), F.col("best.own").alias("best_own")))
    if repeated.count() <= common.MOST_SENT:
        repeated = F.broadcast(repeated)
        met = hashed.join(repeated.select("h"), "h", "left_semi")
    else:  # a large group's texts go to several tasks
        salt = F.pmod(F.xxhash64("doc_id", "own"), F.lit(SALTS)).alias("salt")
        met = hashed.select("*", salt).join(repeated.select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")), ["h", "salt"], "left_semi")
    # all of a group's bytes are equal if its least text is its greatest
    clashing = cut(met.groupBy("h").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).filter("low <> high").select("h"))

    # both sides come straight from a shuffle, if any, so that the skew join can split a large group
    out = keys.join(repeated, "h", "left")
    alone = F.col("size").isNull()
    best_id, best_own, size = F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")), F.coalesce("best_own", "own"), F.coalesce("size", F.lit(1))
    if not clashing.isEmpty():
        collided = hashed.join(clashing, "h")
        classes = collided.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("own_size"), F.min(_preference()).alias("first"))
        apart = collided.join(classes, ["h", "norm"]).groupBy("h", "doc_id", "own", F.sha2("norm", 256).alias("text_sha256"))
        apart = apart.agg(F.max("first").alias("first"), F.max("own_size").alias("own_size"))
        out = join_known(out, apart, "h", "doc_id", "own", "text_sha256", how="left")
        same = F.col("own_size").isNull()
        best_id, best_own = F.when(same, best_id).otherwise(F.col("first.doc_id")), F.when(same, best_own).otherwise(F.col("first.own"))
        size = F.coalesce("own_size", size)
    stays = F.col("doc_id").eqNullSafe(best_id) & (F.col("own") == best_own)
    return out.select("doc_id", "own", best_id.alias("keep_id"), size.cast("long").alias("group_size"), stays.alias("stays"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting space, tab and the line characters; null counts as
    empty, so null, empty and blank texts form one group. Of equal texts the one with the most code
    points in the original stays, then the smallest id; null ids come last. kept tells whether the row's id is the one that
    stays. Rows that repeat an id together with its text count in group_size; keep_first keeps one of them.
    Other columns are not read, so their names can't clash. An empty table gives no rows.

    Plan: ids, lengths and hashes are kept apart from the texts, so that texts are read twice in all. The
    hash groups hold ids and counts only and are combined before the shuffle. Texts of repeated hashes, picked where they
    are read if the hashes are few enough to be sent, are compared byte by byte: a group's least and greatest
    text are combined before their shuffle, so a hot group is one line a task. Groups in which they
    differ (hash collisions) are divided by their texts.
    """
    out = _judged(docs, id_col, text_col)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One input row of every group of equal texts, the one that exact_dedup prefers, with the input's columns."""
    judged = _judged(docs, id_col, text_col)
    return keep_rows(docs, judged.select(F.col("doc_id").cast("long"), "own", F.col("stays").alias("kept")), id_col, text_col)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""
