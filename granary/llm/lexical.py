"""Ranked lexical search with a bit-sliced impact index.

What a term adds to a document's score, its impact, is a whole number. A block of documents has a bitmap for every term
asked for and every bit of its impacts. An item's scores in the block are the sum of its terms' impacts, added bit by
bit for all documents at once as an adder does it: the sum is the exclusive or, the carry goes to the next slice. Going down from the sum's
most significant slice, documents with the bit set go ahead of those without, until the k highest are known.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut_texts, spread

TOP = 10
#: Documents of a block: a bitmap has so many bits.
BLOCK = 4096
#: Items, and characters of their texts, that are looked up in one pass over the documents.
ITEMS, ITEM_CHARS = 1024, 4_000_000
#: Postings up to which a term's bitmaps are set document by document.
FEW = 48
#: Letters, digits and all bytes of characters beyond ASCII stay, letters in lower case; anything else separates.
_KEPT = bytes(x if x >= 128 or chr(x).isalnum() else 32 for x in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order; null has none."""
    return text.encode().translate(_KEPT).split() if text else []


def bit_slices(places: np.ndarray, values: np.ndarray) -> list[int]:
    """Bitmaps of the values' bits, the least significant first; bit p of a bitmap belongs to place p."""
    slices = [0] * int(values.max()).bit_length()
    if len(places) <= FEW:
        for place, value in zip(places.tolist(), values.tolist()):
            at = 1 << place
            while value:
                low = value & -value
                slices[low.bit_length() - 1] |= at
                value ^= low
        return slices
    dense = np.zeros((int(places.max()) // 8 + 1) * 8, np.int64)
    dense[places] = values
    return [int.from_bytes(np.packbits((dense >> k & 1).astype(bool), bitorder="little").tobytes(), "little") for k in range(len(slices))]


def add(total: list[int], slices: list[int]) -> None:
    """Adds the numbers of slices to those of total, for all places at once."""
    total += [0] * (len(slices) - len(total))
    carry = 0
    for k, a in enumerate(total):
        if k >= len(slices) and not carry:
            return
        b = slices[k] if k < len(slices) else 0
        differ = a ^ b
        total[k], carry = differ ^ carry, a & b | differ & carry
    if carry:
        total.append(carry)


def highest(total: list[int], k: int) -> list[tuple[int, int]]:
    """Place and number of the k highest numbers above 0, of equal ones the first places."""
    sure, tied, need = 0, reduce(int.__or__, total, 0), k
    for bits in reversed(total):
        ahead = tied & bits
        many = ahead.bit_count()
        if many > need:
            tied = ahead
        else:
            sure, need, tied = sure | ahead, need - many, tied ^ ahead
            if not need:
                break
    while need and tied:
        low = tied & -tied
        sure, tied, need = sure | low, tied ^ low, need - 1
    out = []
    while sure:
        place = (sure & -sure).bit_length() - 1
        sure &= sure - 1
        out.append((place, sum((bits >> place & 1) << j for j, bits in enumerate(total))))
    return out


def _postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and numbers and occurrences of the asked terms that a document has, as 32-bit integers."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            n, which, often = [], [], []
            for text in batch.column(1).to_pylist():
                found = terms(text)
                has = [(number[t], c) for t, c in Counter(found).items() if t in number]
                n.append(len(found))
                which.append(np.array([x for x, _ in has], "<i4").tobytes())
                often.append(np.array([c for _, c in has], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(which, pa.binary()), pa.array(often, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def _document_counts(postings: DataFrame, many: int) -> DataFrame:
    """term, df; each task adds up its own documents first."""
    import pyarrow as pa

    def run(batches):
        df = np.zeros(many, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=many)
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(df[has])], ["term", "df"])

    return postings.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Block:
    """Up to BLOCK documents, by ascending id with nulls last, and the bit slices of the asked terms' impacts."""

    def __init__(self, rows: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
        self.ids = [r[0] for r in rows]
        lengths = np.array([25 + 75 * r[1] * n_docs // n_terms for r in rows], np.int64)
        which = np.frombuffer(b"".join(r[2] for r in rows), "<i4")
        often = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
        places = np.repeat(np.arange(len(rows)), [len(r[2]) // 4 for r in rows])
        impacts = weights[which] * (1_000_000_000 * often // (1000 * often + 8 * lengths[places]))
        order = np.argsort(which, kind="stable")
        which, self._places, self._impacts = which[order], places[order], impacts[order]
        found, begins = np.unique(which, return_index=True)
        self._spans = dict(zip(found.tolist(), zip(begins.tolist(), [*begins[1:].tolist(), len(which)])))
        self._known: dict[tuple[int, int], list[int]] = {}

    def slices(self, term: int, times: int) -> list[int]:
        """The bitmaps of a term that an item holds so many times; none if no document has it."""
        if term not in self._spans:
            return []
        if (term, times) not in self._known:
            a, b = self._spans[term]
            self._known[term, times] = bit_slices(self._places[a:b], times * self._impacts[a:b]) if self._impacts[a:b].any() else []
        return self._known[term, times]

    def top(self, item: list[tuple[int, int]], k: int) -> list[tuple]:
        total: list[int] = []
        for term, times in item:
            add(total, self.slices(term, times))
        return [(-score, self.ids[place] is None, self.ids[place]) for place, score in highest(total, k)]


def _best(postings: DataFrame, asked: list[list[tuple[int, int]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item (its number), doc_id, score: the k best of each task's documents."""
    import pyarrow as pa

    def run(batches):
        best: list[list[tuple]] = [[] for _ in asked]

        def take(rows):
            block = Block(rows, weights, n_docs, n_terms)
            for at, item in enumerate(asked):
                best[at] = sorted(best[at] + block.top(item, k))[:k]

        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns))
            while len(rows) >= BLOCK:
                take(rows[:BLOCK])
                rows = rows[BLOCK:]
        if rows:
            take(rows)
        out = [(at, i, -score) for at, found in enumerate(best) for score, _, i in found]
        columns = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

    return postings.filter(F.octet_length("terms") > 0).mapInArrow(run, "item int, doc_id long, score long")


def _blocks(items: DataFrame):
    """Blocks of items, each a list of (id, text), bounded in number and text."""
    block, chars = [], 0
    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        chars += len(row[1] or "")
        if len(block) >= ITEMS or chars >= ITEM_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring rows of docs for each row of items, with scores above 0.

    Terms are runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased. A document's score sums, over
    the item's terms with repeats, w * (10^9 tf div (1000 tf + 8 m)), where w is floor(1000 ln((2N + 2) / (2 df + 1))) and m is 25 + 75 n N div L.
    Equal scores go by doc_id, null last. A null text, or one without terms, is found by nothing and doesn't count in N; such an item
    finds nothing. Rows that repeat an id are rows of their own, on either side. Other columns are not read; without
    documents or items there are no rows.

    Items are taken in blocks of ITEMS at most, of which the driver holds one at a time; each is one pass over all documents. A
    document's counts of the asked terms are kept as a row of a few numbers. Blocks of documents are cut where they lie,
    so only k rows an item and task are shuffled.
    """
    spark = docs.sparkSession
    texts = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    kind = dict(items.dtypes)["item_id"]
    parts = []
    for block in _blocks(items):
        counted = [Counter(terms(text)) for _, text in block]
        number = {t: at for at, t in enumerate(sorted({t for c in counted for t in c}))}
        asked = [sorted((number[t], times) for t, times in c.items()) for c in counted]
        postings = cut_texts(_postings(texts, number))
        n_docs, n_terms = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(number), np.int64)
        for row in _document_counts(postings, len(number)).collect():  # one row a term of the block
            weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
        names = spark.createDataFrame([(at, i) for at, (i, _) in enumerate(block)], f"at int, item_id {kind}")
        best = _best(postings, asked, weights, n_docs, n_terms, k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
        parts.append(ranked.join(F.broadcast(names), F.col("item") == F.col("at")).select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


ORACLE = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
items AS MATERIALIZED (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark),
asked AS (SELECT iid, t, count(*) AS times FROM (SELECT iid, unnest(ts) AS t FROM items) GROUP BY iid, t),
held AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM docs) GROUP BY rid, t),
corpus AS (SELECT count(*) AS all_docs, sum(len(ts))::BIGINT AS all_terms FROM docs WHERE len(ts) > 0),
sized AS (SELECT rid, doc_id, 100 - 75 + (75 * len(ts) * all_docs) // all_terms AS m FROM docs, corpus WHERE len(ts) > 0),
weights AS (SELECT t, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, corpus GROUP BY t, all_docs),
scored AS (
  SELECT iid, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (t) JOIN held USING (t) JOIN sized USING (rid) GROUP BY iid, rid, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (iid) WHERE place <= 10
"""
