"""Line dedup by overlapping three-line windows. DataFrame functions only.

Every run of three consecutive lines is hashed; windows found more than once in the corpus lose all but
their first occurrence, and a line goes if any such later window covers it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import SPACES, cut

LINES = 3


def _lines(text: Column) -> Column:
    """The lines that have a word, trimmed, each with its place among all lines."""
    numbered = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(SPACES)).alias("line")))
    return F.filter(numbered, lambda x: x["line"] != "")


def _windows(lines: Column) -> Column:
    """For every run of LINES lines its 128-bit hash and the places it covers."""
    starts = F.when(F.size(lines) >= LINES, F.sequence(F.lit(1), F.size(lines) - (LINES - 1))).otherwise(F.array().cast("array<int>"))

    def window(i):
        part = F.slice(lines, i, LINES)
        digest = F.unhex(F.md5(F.array_join(F.transform(part, lambda x: x["line"]), "\n")))
        return F.struct(digest.alias("h"), part["at"].alias("at"), i.alias("nth"))

    return F.transform(starts, window)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key and places (from 0, ascending) of the lines to remove, for the documents that lose any.

    Only lines with a word make windows; blank lines lie between them and are never removed. Lines are
    compared without the white space around them. Windows are ranked by doc_id, null last, then by place;
    the first one of equal windows stays. A text of fewer than LINES lines with a word, or null, has no
    window. Every removed line's text remains somewhere in an earlier place. Rows that repeat an id,
    null ids as well, rank alike by place, so equal rows don't remove each other's lines; text_key, a hash
    of the text, tells which of them the places belong to.

    Windows leave their document as a hash, an id and a place. First occurrences are minima, combined
    before the shuffle, of the repeated hashes only; windows meet them in a join that the adaptive skew
    join splits where a window is very common.
    """
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), _lines(F.col(text_col)).alias("lines")).filter(F.size("lines") >= LINES)
    found = lines.select("doc_id", "text_key", F.explode(_windows(F.col("lines"))).alias("w")).select("doc_id", "text_key", "w.h", "w.at", "w.nth")
    found = cut(found)
    # ids and places are two numbers each: their least pair is the place at the least id
    firsts = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "nth")).alias("first"))
    firsts = firsts.filter("n > 1").select("h", F.col("first.doc_id").alias("first_id"), F.col("first.nth").alias("first_nth"))
    later = found.join(firsts, "h").filter(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == F.col("first_nth"))))
    covered = later.select("doc_id", "text_key", F.explode("at").alias("place")).distinct()
    return covered.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list("place")).alias("places"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows and columns, texts without the lines that repeated_lines names."""
    gone = max(docs.columns, key=len, default="") + "_gone"
    lines = repeated_lines(docs, id_col, text_col).select(F.struct("*").alias(gone))
    same = docs[id_col].cast("long").eqNullSafe(F.col(f"`{gone}`.doc_id")) & (F.xxhash64(docs[text_col]) == F.col(f"`{gone}`.text_key"))
    rows, places = docs.join(lines, same, "left"), F.col(f"`{gone}`.places")
    left = F.filter(F.split(docs[text_col], "\n"), lambda x, i: ~F.array_contains(places, i))
    text = F.when(places.isNull(), docs[text_col]).otherwise(F.array_join(left, "\n"))
    return rows.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, places and the SHA-256 of the text that is left."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    gone = repeated_lines(docs).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), F.col("places").alias("gone_places"))
    rows = texts.join(gone, texts["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64("text") == gone["gone_key"]), "left")
    places = F.coalesce("gone_places", F.array().cast("array<int>"))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(places, i)), "\n")
    return rows.select(
        "doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.size(places).cast("long").alias("n_removed"),
        F.array_join(places, ",").alias("places"), F.sha2(F.when(F.size(places) == 0, F.col("text")).otherwise(left), 256).alias("text_sha256"),
    )


ORACLE = r"""
WITH raw AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
flat AS (SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS part FROM raw),
words AS (SELECT doc_id, pos, trim(part, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM flat),
lines AS (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM words WHERE line <> ''),
wins AS (
  SELECT doc_id, nth, pos AS a1, lead(pos, 1) OVER w AS a2, lead(pos, 2) OVER w AS a3,
         md5(line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w) AS h
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY nth)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, nth) AS r FROM wins WHERE a3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([a1, a2, a3]) AS pos FROM ranked WHERE r > 1),
kept AS (
  SELECT f.doc_id, count(g.pos) AS n_removed, count(*) AS n_lines,
         coalesce(string_agg(g.pos::VARCHAR, ',' ORDER BY f.pos), '') AS places,
         coalesce(string_agg(f.part, chr(10) ORDER BY f.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM flat f LEFT JOIN gone g USING (doc_id, pos) GROUP BY f.doc_id)
SELECT doc_id, n_lines, n_removed, places, sha256(text) AS text_sha256 FROM kept
"""
