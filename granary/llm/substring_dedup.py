"""Substring dedup: lines and the sentences inside them are hashed, and of equal units the earliest stays.

A unit is a line of any length, or a sentence of a line that has several, so a passage that is repeated inside
a longer paragraph is found as well. A sentence too short to stand for itself is a unit together with as many
of its neighbours as it takes, once with those before and once with those after. Units are compared by their words, without case, punctuation at their ends and
white space. Offsets are code points of the original text.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut_texts, spread

#: Words, or else characters but blanks (for scripts that write none between words), from which a sentence within a
#: line is a unit by itself.
SENTENCE_WORDS, SENTENCE_CHARS = 8, 40
_LINE = re.compile(r"[^\n]+")
_MARK = re.compile(r"[。！？]+[\"')\]»”’」』）]*\s*|[.!?…]+[\"')\]»”’]*(?:\s+|$)")
_EDGES = " \t\r\x0b\x0c.,;:!?…。\"'()[]«»“”‘’-！？「」『』（）"


def _sentences(line: str, offset: int):
    """(begin, end) of the sentences of a line: they end with a mark that white space or the line's end follows, or a wide one."""
    begin = 0
    for mark in _MARK.finditer(line):
        yield offset + begin, offset + mark.end()
        begin = mark.end()
    if begin < len(line):
        yield offset + begin, offset + len(line)


def _digest(words: list[str]) -> bytes:
    whole = " ".join(words)
    return xxhash.xxh3_128_digest((whole.strip(_EDGES) or whole).encode())


def _groups(sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first, last) of the runs of sentences that are units: long ones, and short ones with the neighbours they need."""

    def enough(n_words, n_chars):
        return n_words >= SENTENCE_WORDS or n_chars >= SENTENCE_CHARS

    out = set()
    for k, size in enumerate(sizes):
        if enough(*size):
            out.add((k, k))
            continue
        for step, stop in ((-1, -1), (1, len(sizes))):
            n_words = n_chars = 0
            for j in range(k, stop, step):
                n_words, n_chars = n_words + sizes[j][0], n_chars + sizes[j][1]
                if enough(n_words, n_chars):
                    out.add((min(j, k), max(j, k)))
                    break
    return sorted(out)


def units(text: str | None) -> list[tuple[bytes, int, int]]:
    """(digest, begin, end) of the units of a text, lines before their sentences; a line of one sentence is one unit.

    A run of sentences that overlaps the last equal one (in a line that says the same again and again) is left out.
    """
    out, ends = [], {}
    for m in _LINE.finditer(text or ""):
        line, begin = m[0], m.start()
        words = line.casefold().split()
        if not words:
            continue
        out.append((_digest(words), begin, m.end()))
        places = list(_sentences(line, begin))
        if len(places) < 2:
            continue
        parts = [text[a:b].casefold().split() for a, b in places]
        for i, j in _groups([(len(x), sum(map(len, x))) for x in parts]):
            a, b = places[i][0], places[j][1]
            digest = _digest(text[a:b].casefold().split())
            if (i, j) == (0, len(places) - 1) or a < ends.get(digest, 0):
                continue
            ends[digest] = b
            out.append((digest, a, b))
    return out


def _found(texts: DataFrame) -> DataFrame:
    """One row per distinct unit of every document, and places of the unit in it: the first, and all later ones."""
    import pyarrow as pa

    names = ["doc_id", "text_key", "h1", "h2", "begin", "end", "more"]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own: dict[bytes, list[int]] = {}
                for digest, a, b in units(text):
                    own.setdefault(digest, []).extend((a, b))
                for digest, places in own.items():
                    first, second = np.frombuffer(digest, np.int64).tolist()
                    rows.append((doc_id, key, first, second, places[0], places[1], places[2:] or None))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts.mapInArrow(run, "doc_id long, text_key long, h1 long, h2 long, begin long, end long, more array<int>")


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per removed unit: doc_id, text_key, begin, end, first_id.

    Of equal units the one in the smallest doc_id stays, and there the first; first_id is that document,
    the same one's if it repeats the unit itself. Null ids rank last. A null or empty text has no units.
    Rows that repeat an id, null ids as well, don't remove each other's units; text_key, a hash of the
    text, tells which of them the offsets belong to.

    A document's own repeats are settled where it is read. Of each of its units one row goes on; counts
    and least ids are combined before the shuffle. The join that brings the least id back to the rows is
    split by the adaptive skew join where a unit is very common.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_key"))
    found = cut_texts(_found(spread(texts)))
    seen = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = found.join(seen, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    across = later.select("doc_id", "text_key", "begin", "end", "first_id")
    place = lambda i, name: F.get("more", i).cast("long").alias(name)
    pairs = F.transform(F.expr("sequence(0, size(more) div 2 - 1)").cast("array<int>"), lambda i: F.struct(place(2 * i, "begin"), place(2 * i + 1, "end")))
    within = found.filter("more IS NOT NULL").select("doc_id", "text_key", F.explode(pairs).alias("p"))
    return across.union(within.select("doc_id", "text_key", "p.begin", "p.end", F.col("doc_id").alias("first_id")))


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, begin, end, first_id, n_units: the removed units of each document, overlapping ones as one span.

    first_id is the smallest id among the documents that keep a unit of the span. A document's spans are
    disjoint and lie in the original text: begin and end count its code points, end is the first one kept.
    """
    units_gone = repeated_units(docs, id_col, text_col)
    order = Window.partitionBy("doc_id", "text_key").orderBy("begin", F.desc("end"))
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = units_gone.withColumn("fresh", (reached.isNull() | (F.col("begin") >= reached)).cast("int"))
    spans = starts.withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sums = [F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("first_id").alias("first_id"), F.count(F.lit(1)).alias("n_units")]
    return spans.groupBy("doc_id", "text_key", "span").agg(*sums).drop("span")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """The input rows and columns, texts without their removed spans; if named, a column keeps the spans' offsets."""
    spans, gone = removed_spans(docs, id_col, text_col), max(docs.columns, key=len, default="") + "_gone"
    grouped = spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans")).select(F.struct("*").alias(gone))
    same = docs[id_col].cast("long").eqNullSafe(F.col(f"`{gone}`.doc_id")) & (F.xxhash64(docs[text_col]) == F.col(f"`{gone}`.text_key"))
    rows, found = docs.join(grouped, same, "left"), F.col(f"`{gone}`.spans")
    # what lies between the spans, from the end of one to the begin of the next
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(found, lambda x: x["end"]))
    ends = F.concat(F.transform(found, lambda x: x["begin"]), F.array(F.length(docs[text_col]).cast("long")))
    left = F.zip_with(begins, ends, lambda a, b: F.substring(docs[text_col], (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(found.isNull(), docs[text_col]).otherwise(F.array_join(left, ""))
    return rows.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns], *([found.alias(spans_col)] if spans_col else []))
