"""Quality rules with thresholds taken from the corpus, per language and source.

Each document gets counts from its whole text. Four ratios of them are summarised for each (language,
source) in a quantile sketch with logarithmic buckets: bucket counts, which merge by addition, so the
sketch is a grouped count that is combined before its shuffle, is exact to a bucket's width and gives
the same limits in every run. The limits join back to the documents.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import common
from granary.llm.common import SPACES, cut_few, cut_texts, spread, text_key
from granary.llm.words import repeated_words, word_hashes

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
#: A bucket's upper edge is so many times its lower edge.
GAMMA = 1.02
#: A quantile of a source is as sure as rows lie beyond it: its language's counts as so many rows beyond it, likewise the corpus's for a language's.
ROWS_BEYOND = 10
#: Each ratio in thousandths: its formula, the quantile that shows the spread of its upper side (and the lower one, if that side has a
#: limit), and how many thousandths one find more makes in a document of median length.
RATIOS = {
    "symbols": ("1000 * n_symbols div greatest(n_words, 1)", 0.9, None, "1000 / n_words"),
    "word_length": ("1000 * word_chars div greatest(n_words, 1)", 0.9, 0.1, "1000 / n_words"),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 0.98, None, "1000 / n_lines"),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 0.98, None, f"{2 * REPEAT_WINDOW} * 1000 / n_words"),
}
#: Document lengths whose medians are read beside the ratios'.
LENGTHS = ("n_words", "n_lines")
#: A limit lies where so many standard deviations of a normal distribution with the same median and quantile would end.
DEVIATIONS = 6.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]").search


def counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; null counts as empty."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if _HAS_WORD(x)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(word_hashes(words), REPEAT_WINDOW),
    )


def measured(df: DataFrame, text_col: str, into: str) -> DataFrame:
    """df with the counts of its text in a struct column; no shuffle, rows stay in their partitions."""
    import pyarrow as pa

    kind = pa.struct([(c, pa.int64()) for c in COUNTS])
    place = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            rows = [counts(text) for text in batch.column(place).to_pylist()]
            columns = list(zip(*rows)) or [[]] * len(COUNTS)
            made = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, into])

    schema = T.StructType([*df.schema.fields, T.StructField(into, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])
    return df.mapInArrow(run, schema)


def _bucket(x: Column) -> Column:
    """0 for 0, else the number of the logarithmic bucket."""
    return F.when(x <= 0, F.lit(0)).otherwise(1 + F.floor(F.log(x.cast("double")) / math.log(GAMMA))).cast("int")


def _value(bucket: Column) -> Column:
    """The upper edge of a bucket: nothing in it is more."""
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), bucket))


def _stretch(level: float) -> float:
    """From a quantile's distance to the median to DEVIATIONS standard deviations."""
    return DEVIATIONS / NormalDist().inv_cdf(max(level, 1 - level))


def _own(choices: dict, kind: str = "double") -> Column:
    """The choice for the row's ratio."""
    return F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v).cast(kind)) for k, v in choices.items() if v is not None])


def limits(features: DataFrame) -> DataFrame:
    """lang, source and for each ratio its lowest and highest allowed value, for every (lang, source) there is.

    features: lang, source and the COUNTS, of all documents that pass the base rules. The median and the quantile that
    a ratio's limit follows are read from every source's own sketch, its language's and the corpus's. A source's quantile q of n rows
    counts n / (n + ROWS_BEYOND / (1 - q)) and its language's the rest, and so on upwards: a source of few rows is judged mostly as
    its language, a large one as itself. The limit is as far from the median as the quantile says, and at least
    what one find more makes in a document of median length, so that a uniform corpus loses nothing. Nothing else is fixed:
    sources of other habits have other limits, and one dominant junk source cannot move those of others.
    """
    numbers = {k: F.expr(x[0]) for k, x in RATIOS.items()} | {k: F.col(k) for k in LENGTHS}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), _bucket(x).alias("bucket")) for k, x in numbers.items()]))
    fine = features.select("lang", "source", pairs.alias("p")).groupBy("lang", "source", "p.ratio", "p.bucket").agg(F.count(F.lit(1)).alias("n"))
    fine = cut_few(fine)
    levels = {"mid": dict.fromkeys(numbers, 0.5), "top": {k: x[1] for k, x in RATIOS.items()}, "low": {k: x[2] for k, x in RATIOS.items()}}
    found = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        sketch = fine.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
        total = Window.partitionBy(*keys, "ratio")
        upto = total.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ranked = sketch.withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(total)})
        quantile = lambda q: _value(F.min(F.when(F.col("upto") >= F.col("rows") * q, F.col("bucket"))))
        read = ranked.groupBy(*keys, "ratio").agg(*[quantile(_own(q)).alias(name) for name, q in levels.items()], F.max("rows").alias("rows"))
        found.append((keys, read.select(*[F.col(k).alias(f"{k}_{level}") for k in keys], F.col("ratio").alias(f"ratio_{level}"), F.struct(*levels, "rows").alias(f"s_{level}"))))
    out = fine.select("lang", "source", "ratio").distinct()
    for level, (keys, read) in enumerate(found):
        same = [out[k].eqNullSafe(read[f"{k}_{level}"]) for k in keys] + [out["ratio"] == read[f"ratio_{level}"]]
        out = out.join(read, reduce(Column.__and__, same), "left").select(out["*"], f"s_{level}")
    best = {x: F.col(f"s_2.{x}") for x in levels}
    beyond = {x: ROWS_BEYOND / _own({k: q and 1 - max(q, 1 - q) for k, q in qs.items()}) for x, qs in levels.items()}
    for level in (1, 0):
        rows = F.col(f"s_{level}.rows")
        best = {x: (rows * F.col(f"s_{level}.{x}") + beyond[x] * parent) / (rows + beyond[x]) for x, parent in best.items()}
    out = out.select("lang", "source", "ratio", *[c.alias(x) for x, c in best.items()])

    of = lambda name, k: F.max(F.when(F.col("ratio") == k, F.col(name)))
    wide = out.groupBy(F.col("lang").alias("limit_lang"), F.col("source").alias("limit_source")).agg(
        *[of("mid", k).alias(k) for k in LENGTHS], *[of(x, k).alias(f"{x}_of_{k}") for k in RATIOS for x in levels]
    )
    bounds = []
    for k, (_, top, low, step) in RATIOS.items():
        mid, one = F.col(f"mid_of_{k}"), F.expr(step)
        bounds.append((mid + F.greatest(_stretch(top) * (F.col(f"top_of_{k}") - mid), one)).alias(f"high_{k}"))
        bounds.append((mid - F.greatest(_stretch(low) * (mid - F.col(f"low_of_{k}")), one) if low else F.lit(-1.0)).alias(f"low_{k}"))
    return wide.select("limit_lang", "limit_source", *bounds)


def base_failed(at: str = "") -> Column:
    """Too few words, or too many of them inside repeated windows."""
    return F.expr(f"{at}n_words < {MIN_WORDS} OR 100 * {at}n_repeat_words > {REPEAT_PERCENT} * {at}n_words")


def _within(counts_of, limit_of) -> Column:
    """Whether all ratios lie within the joined limits; rows without limits pass."""
    inside = F.lit(True)
    for k, (formula, *_) in RATIOS.items():
        for c in COUNTS:
            formula = re.sub(rf"\b{c}\b", counts_of(c), formula)
        inside = inside & F.expr(f"coalesce(({formula}) BETWEEN {limit_of('low_' + k)} AND {limit_of('high_' + k)}, true)")
    return inside


def _known(df: DataFrame, table: DataFrame) -> DataFrame:
    return df.join(table, df["lang"].eqNullSafe(table["limit_lang"]) & df["source"].eqNullSafe(table["limit_source"]), "left")


def _features(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("own"))
    return cut_texts(measured(spread(picked), "text", "m").select("doc_id", "lang", "source", "own", "m.*"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed and kept.

    A document is kept if it passes the base rules and all its ratios lie within the limits of its
    language and source. A null or empty text has no words and fails the base rules. Null languages and
    sources form groups of their own. Repeated rows are judged alike; other columns are not read; an
    empty table gives no rows.
    """
    features = _features(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", base_failed())
    judged = _known(features, limits(features.filter("NOT base_failed")))
    kept = ~F.col("base_failed") & _within(str, str)
    return judged.select("doc_id", *[c for c in COUNTS if c != "n_lines"], "base_failed", kept.alias("kept"), "n_lines", "lang", "source")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The input rows that quality_rules keeps, with the input's columns.

    Texts are never shuffled. If the rejected rows are few enough to be sent, the input's rows are looked up among them by id, language,
    source and the text's key; otherwise the counts are taken a second time where the rows pass through.
    """
    features = _features(docs, id_col, text_col, lang_col, source_col)
    table = cut_few(limits(features.filter(~base_failed())))
    judged = _known(features, table)
    mark = lambda own, *keys: F.xxhash64(own, *[x for k in keys for x in (k, k.isNull())])
    rejected = judged.filter(base_failed() | ~_within(str, str)).select("doc_id", mark(F.col("own"), F.col("lang"), F.col("source")).alias("mark"))
    rejected = cut_few(rejected.distinct().withColumnsRenamed({"doc_id": "rejected_id", "mark": "rejected_mark"}))
    if rejected.count() <= common.MOST_SENT:
        same = docs[id_col].eqNullSafe(rejected["rejected_id"]) & (mark(text_key(docs[text_col]), docs[lang_col], docs[source_col]) == rejected["rejected_mark"])
        return docs.join(F.broadcast(rejected), same, "left_anti")
    spare, limit = (max(docs.columns, key=len, default="") + end for end in ("_m", "_limits"))
    rows = measured(docs, text_col, spare).filter(~base_failed(f"`{spare}`."))
    table = table.select(F.struct("*").alias(limit))
    same = rows[lang_col].eqNullSafe(F.col(f"`{limit}`.limit_lang")) & rows[source_col].eqNullSafe(F.col(f"`{limit}`.limit_source"))
    kept = rows.join(table, same, "left").filter(_within(lambda c: f"`{spare}`.{c}", lambda c: f"`{limit}`.{c}"))
    return kept.select(*[rows[c] for c in docs.columns])
