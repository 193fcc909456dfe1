"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Every source is cut into blocks of rows. Its quota is a number of whole passes over all its blocks plus
a part of one more pass, which takes blocks in a permuted order and splits the last of them between rows.
The blocks of all passes are dealt to the output shards: a binary tree halves the range of shards, and at
each node draws how many of every source's blocks go left, without replacement, so that the leaves hold
exact quotas. Each shard takes its quota of a source as one run of the source's permuted blocks, disjoint
from all other runs, and orders its rows by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import cut, cut_few, join_known, word_count

WEIGHTS = (5, 2, 1)
#: No source gives more than so many times its size.
MOST_PASSES = 3
#: Rows of a block at which a source gets more blocks, and the most blocks of a source (powers of two).
BLOCK_ROWS, MOST_BLOCKS = 8, 1024
#: A pass that is taken in part chooses from at least so many rows, in so many rounds.
SPARE_ROWS, ROUNDS = 128, 4
#: Rows, at least, from the place on where the part of a pass ends, among which it chooses.
NEAR_ROWS = 1024
#: Keys of rows that differ only in so many lowest bits are one range: 4096 ranges.
RANGE_BITS = 52
#: Output shards, a power of two.
SHARDS = 16
SEED = "mix-1"


def _key(*parts) -> Column:
    return F.xxhash64(F.lit(SEED), *[x if isinstance(x, Column) else F.col(x) for x in parts])


def _chance(*parts) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(_key(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """sizes (one row per source: source, source_size, ...) with a column target.

    Weights repeat over the sources in code-point order, null last. All targets rise together in
    proportion to their weights until they use up the total size; a source stops rising at most times its
    size. Sources stop in order of cap / weight, so the level reached is the first one, in that order,
    that its own source doesn't stop. That is where resharing the excess by weight comes to rest.
    Sources are few next to rows: one task orders them.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(most)).withColumn("_stop", F.col("_cap") / F.col("_w"))
    by_stop = Window.orderBy("_stop", F.col("source").isNull(), "source")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    full, risen = F.coalesce(F.sum("_cap").over(before), F.lit(0.0)), F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", (F.sum("source_size").over(everything) - full) / (F.sum("_w").over(everything) - risen))
    rows = rows.withColumn("_n", F.row_number().over(by_stop))
    first = F.min(F.when(F.col("_level") <= F.col("_stop"), F.struct("_n", "_level"))).over(everything)["_level"]
    rows = rows.withColumn("target", F.least(F.col("_cap"), first * F.col("_w")))
    return rows.select(*sizes.columns, "target")


def _let(value: Column, body) -> Column:
    """body of a value that is worked out once; an expression inside a lambda is worked out at every call."""
    return F.transform(F.array(value), body)[0]


def _drawn(chance: Column, picks: Column, good: Column, rest: Column) -> Column:
    """How many of `good` blocks are among `picks` drawn from `good + rest`: hypergeometric, at that chance.

    Three walks over the possible counts add up the logarithms of the ratios of neighbouring
    probabilities: for the largest, for the sum relative to it, and to the count that the chance falls on.
    """
    low, high = F.greatest(F.lit(0), picks - rest), F.least(picks, good)
    counts = F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<int>"))

    def ratio(k):
        return F.log(((good - k + 1).cast("double") * (picks - k + 1)) / (k.cast("double") * (rest - picks + k)))

    def walk(start: dict, merge) -> Column:
        """Folds over the counts with log, the logarithm of a count's probability relative to the lowest count's."""
        first = F.struct(F.lit(0.0).alias("log"), *[v.alias(k) for k, v in start.items()])
        return F.aggregate(counts, first, lambda a, k: _let(a["log"] + ratio(k), lambda log: F.struct(log.alias("log"), *[v.alias(n) for n, v in merge(a, log).items()])))

    def reached(top, wanted):
        at = walk(
            {"sum": F.exp(-top), "n": F.lit(0)},
            lambda a, log: {"sum": a["sum"] + F.exp(log - top), "n": a["n"] + (a["sum"] <= wanted).cast("int")},
        )
        return F.least(low + at["n"], high)

    top = walk({"most": F.lit(0.0)}, lambda a, log: {"most": F.greatest(a["most"], log)})["most"]
    total = lambda t: walk({"sum": F.exp(-t)}, lambda a, log: {"sum": a["sum"] + F.exp(log - t)})["sum"]
    return _let(top, lambda t: _let(chance * total(t), lambda wanted: reached(t, wanted)))


def shard_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """source and quota: how many of its blocks each shard gets, as an array with one number per shard.

    quotas: source, n. A tree node is one row per source; its draws run over the sources one after
    another, since each depends on what the sources before it took, so a node's sources stand in one array.
    """
    entry = F.struct(F.col("source").isNull().alias("none"), "source", F.col("n").cast("int").alias("n"))
    node = quotas.agg(F.array_sort(F.collect_list(entry)).alias("q")).withColumn("node", F.lit(1))
    for _ in range(shards.bit_length() - 1):
        everything = F.aggregate("q", F.lit(0), lambda acc, x: acc + x["n"])
        # an odd block goes left at even nodes and right at odd ones
        picks = F.floor((everything + 1 - F.pmod(F.col("node"), F.lit(2))) / 2).cast("int")
        start = F.struct(everything.alias("rest"), picks.alias("picks"), F.array().cast("array<int>").alias("taken"))

        def draw(acc, x):
            k = _drawn(_chance(F.col("node"), x["source"]), acc["picks"], x["n"], acc["rest"] - x["n"])
            left = (acc["rest"] - x["n"]).alias("rest")
            return _let(k, lambda k: F.struct(left, (acc["picks"] - k).alias("picks"), F.concat(acc["taken"], F.array(k)).alias("taken")))

        node = node.withColumn("taken", F.aggregate("q", start, draw)["taken"])
        part = lambda n: F.zip_with("q", "taken", lambda x, t: F.struct(x["none"].alias("none"), x["source"].alias("source"), n(x, t).alias("n")))
        left = F.struct((F.col("node") * 2).alias("node"), part(lambda x, t: t).alias("q"))
        right = F.struct((F.col("node") * 2 + 1).alias("node"), part(lambda x, t: x["n"] - t).alias("q"))
        node = node.select(F.explode(F.array(left, right)).alias("half")).select("half.node", "half.q")
    leaves = node.select((F.col("node") - shards).alias("shard"), F.explode("q").alias("s"))
    shares = F.array_sort(F.collect_list(F.struct("shard", "s.n")))
    return leaves.groupBy("s.source").agg(F.transform(shares, lambda x: x["n"]).alias("quota"))


def _chosen(near: DataFrame) -> DataFrame:
    """source and runs: which rows to take of the blocks that have room for a part of their words.

    near: source, room, size, key, id. Rows are taken in key order for as long as they fit; each of the next
    rounds goes on behind the first row that didn't, with the rows that fit what is left. A run
    takes the rows after `after` and up to `upto` with at most `most` words. Keys fall into ranges whose sums are
    combined before the shuffle: the ranges that fit are one run, and the rounds see the rows of the range in which it
    ends, and of some more, so a window holds a small part of a block. Its default frame holds all
    rows of a key, so rows that repeat an id stand or fall together.
    """
    most = F.lit(2**63 - 1)
    block, in_order = Window.partitionBy("source"), Window.partitionBy("source").orderBy("range")
    keyed = near.withColumn("range", F.shiftright("key", RANGE_BITS))
    fitting = F.sum(F.when(F.col("size") <= F.col("room"), F.col("size")).otherwise(0))
    ranges = keyed.groupBy("source", "room", "range").agg(fitting.alias("words"), F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumn("upto_words", F.sum("words").over(in_order)).withColumn("first", F.min(F.when(F.col("upto_words") > F.col("room"), F.col("range"))).over(block))
    spare = F.sum(F.when(F.col("range") >= F.col("first"), F.col("n"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    ranges = cut_few(ranges.withColumn("spare", F.coalesce(spare, F.lit(0))))
    whole = ranges.groupBy("source", "room", "first").agg(F.coalesce(F.max(F.when(F.col("first").isNull() | (F.col("range") < F.col("first")), F.col("upto_words"))), F.lit(0)).alias("before"))
    last = F.struct(F.coalesce(F.shiftleft(F.col("first") - 1, RANGE_BITS).bitwiseOR((1 << RANGE_BITS) - 1), most).alias("key"), most.alias("id"))
    none = F.lit(None).cast("struct<key:bigint,id:bigint>")
    whole = whole.withColumn("run", F.when(F.col("before") > 0, F.struct(none.alias("after"), last.alias("upto"), F.col("room").alias("most"))))

    at = F.struct("key", "id")
    rows = join_known(keyed.drop("room"), ranges.filter(f"range >= first AND spare < {NEAR_ROWS}").select("source", "range"), "source", "range")
    rows = join_known(rows, whole.select("source", (F.col("room") - F.col("before")).alias("room"), "run.upto"), "source").withColumnRenamed("upto", "after")
    for k in range(ROUNDS):
        fits = (F.col("after").isNull() | (at > F.col("after"))) & (F.col("size") <= F.col("room"))
        rows = rows.withColumn("sum", F.sum(F.when(fits, F.col("size")).otherwise(0)).over(block.orderBy("key", "id")))
        rows = rows.withColumn("taken", fits & (F.col("sum") <= F.col("room")))
        rows = rows.withColumn("upto", F.max(F.when(F.col("taken"), at)).over(block)).withColumn("used", F.max(F.when(F.col("taken"), F.col("sum"))).over(block))
        rows = rows.withColumn(f"run{k}", F.when(F.col("upto").isNotNull(), F.struct("after", "upto", F.col("room").alias("most"))))
        rows = rows.withColumn("room", F.col("room") - F.coalesce("used", F.lit(0))).withColumn("after", F.coalesce("upto", "after"))
    runs = rows.groupBy("source").agg(*[F.max(f"run{k}").alias(f"run{k}") for k in range(ROUNDS)])
    out = join_known(whole.select("source", "run"), runs, "source", how="left")
    return out.select("source", F.array_compact(F.array("run", *[f"run{k}" for k in range(ROUNDS)])).alias("runs"))


def block_plan(rows: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES, shards: int = SHARDS) -> DataFrame:
    """What to take of each block: source, blocks, block, source_size, target, whole, part.

    rows: doc_id, source, size. whole lists (pass, shard) of the passes that take the block's rows. part
    is null, or (pass, shard, runs) of the pass that takes only some of its rows.
    """
    fine = cut_few(rows.groupBy("source", F.pmod(_key("doc_id"), F.lit(MOST_BLOCKS)).alias("cell")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    totals = fine.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    per_source = source_targets(totals, weights, most)
    halvings = F.ceil(F.log2(F.greatest(F.col("n") / BLOCK_ROWS, F.lit(1.0)))).cast("int")
    blocks = F.least(F.lit(MOST_BLOCKS), F.pow(F.lit(2), halvings)).cast("long")
    # the part of a pass is the target beyond whole passes
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    per_source = per_source.select("source", "source_size", "target", blocks.alias("blocks"), passes.alias("passes"))
    per_source = cut_few(per_source.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))

    cells = join_known(fine.withColumnRenamed("n", "rows"), per_source, "source")
    keys = [*per_source.columns, F.pmod("cell", "blocks").alias("block")]
    sized = cells.groupBy(*keys).agg(F.sum("words").alias("words"), F.sum("rows").alias("rows"))
    source = Window.partitionBy("source")
    permuted = source.orderBy(_key("source", "block", "passes"), "block")
    sized = sized.withColumn("before", F.sum("words").over(permuted) - F.col("words")).withColumn("rows_before", F.sum("rows").over(permuted) - F.col("rows"))
    # the block that the part of a pass ends in, and the blocks behind it that rows may come from
    ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    sized = sized.withColumn("end", F.max(F.when(ends, F.struct("rows_before", (F.col("rest") - F.col("before")).alias("room")))).over(source))
    # 0: not in the last pass, 1: some of its rows, 2: whole
    near = ends | ((F.col("before") >= F.col("rest")) & (F.col("rows_before") < F.col("end.rows_before") + SPARE_ROWS))
    last = F.when(F.col("words") == 0, 0).when(F.col("before") + F.col("words") <= F.col("rest"), 2).when(near, 1).otherwise(0)
    sized = cut_few(sized.withColumn("last", last).withColumn("room", F.col("end.room")).drop("end", "rows", "rows_before"))

    count = F.col("passes") + (F.col("last") > 0).cast("int")
    taken = sized.filter(count > 0).select("source", "block", "passes", "last", F.explode(F.sequence(F.lit(0), count - 1)).alias("pass"))
    dealt = Window.partitionBy("source").orderBy(_key("source", "pass", "block"), "block", "pass")
    taken = cut_few(taken.withColumn("place", F.row_number().over(dealt)))
    quotas = cut_few(shard_quotas(taken.groupBy("source").agg(F.count(F.lit(1)).alias("n")), shards))
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice("quota", 1, i), F.lit(0), lambda a, x: a + x))
    ended = F.size(F.filter(upto, lambda e: e < F.col("place")))
    taken = join_known(taken, quotas, "source").withColumn("to", F.struct("pass", ended.alias("shard")))
    split = (F.col("pass") == F.col("passes")) & (F.col("last") == 1)
    placed = taken.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.when(~split, F.col("to")))).alias("whole"), F.max(F.when(split, F.col("to"))).alias("split"))

    # rows of the blocks that are taken in part: of each source one block, or more if that has few rows
    partial = sized.filter("last = 1").select("source", "blocks", "block", "room")
    near = join_known(rows, partial, "source").filter(F.pmod(_key("doc_id"), F.col("blocks")) == F.col("block"))
    near = near.select("source", "room", "size", _key("doc_id", F.lit("row")).alias("key"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    ends = _chosen(near)

    out = join_known(sized, placed, "source", "block", how="left")
    out = join_known(out, ends, "source", how="left")
    part = F.when(F.col("split").isNotNull() & F.col("runs").isNotNull(), F.struct("split.pass", "split.shard", "runs"))
    whole = F.coalesce("whole", F.array().cast("array<struct<pass:int,shard:int>>"))
    return cut_few(out.select("source", "blocks", "block", "source_size", "target", whole.alias("whole"), part.alias("part")))


def _placements(doc_id: Column, size: Column, at: str) -> Column:
    """(pass, shard) of every time a row is taken."""
    key = F.struct(_key(doc_id, F.lit("row")).alias("key"), F.coalesce(doc_id, F.lit(0)).alias("id"))
    part = F.col(f"`{at}`.part")
    taken = F.exists(part["runs"], lambda r: (r["after"].isNull() | (key > r["after"])) & (key <= r["upto"]) & (size <= r["most"]))
    also = F.array(F.struct(part["pass"].alias("pass"), part["shard"].alias("shard")))
    return F.when(part.isNotNull() & taken, F.concat(F.col(f"`{at}`.whole"), also)).otherwise(F.col(f"`{at}`.whole"))


def _joined(rows: DataFrame, plan: DataFrame, id_col: str, source_col: str, at: str) -> DataFrame:
    """Each row with its block's line of the plan in the struct column `at`.

    All rows of a source know its number of blocks only through the plan, so rows meet their cell's line:
    a block's line is repeated for the cells it is made of, at most MOST_BLOCKS for each source.
    """
    cells = plan.withColumn("cell", F.explode(F.expr(f"sequence(block, {MOST_BLOCKS - 1}L, blocks)"))).select(F.struct("*").alias(at))
    cell = F.pmod(_key(rows[id_col]), F.lit(MOST_BLOCKS))
    return rows.join(cells, rows[source_col].eqNullSafe(F.col(f"`{at}`.source")) & (cell == F.col(f"`{at}`.cell")))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, placements.

    size is the number of words (null text: 0). placements lists pass and shard of every time the mix
    takes the row, none if it doesn't. Whole rows are taken, so a source gives its target to within less
    than one row, and never more. Null sources are one source; rows with one id, in one source, are taken alike; rows of
    a corpus without words are not taken; an empty table gives no rows. The draws depend on ids, sources
    and SEED alone: reruns agree.
    """
    rows = _rows(docs, id_col, text_col, source_col)
    found = _joined(rows, block_plan(rows, **how), "doc_id", "source", "_b")
    return found.select("doc_id", rows["source"], "size", "_b.source_size", "_b.target", _placements(rows["doc_id"], F.col("size"), "_b").alias("placements"))


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of every row."""
    taken = (F.col("size") * F.size("placements")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken, "source", "placements")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_col: str | None = None, **how) -> DataFrame:
    """The input's rows, each as often as the mix takes it, with the input's columns and, if named, the shard."""
    plan = block_plan(_rows(docs, id_col, text_col, source_col), **how)
    at = max(docs.columns, key=len, default="") + "_b"
    out = _joined(docs, plan, id_col, source_col, at)
    out = out.select(*[docs[c] for c in docs.columns], F.explode(_placements(docs[id_col].cast("long"), word_count(docs[text_col]), at)).alias(at))
    return out.select(*docs.columns, *([F.col(f"`{at}`.shard").alias(shard_col)] if shard_col else []))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", shard_col: str = "to_shard", **how) -> None:
    """Writes the mix to path, a directory for each shard (shard_col, a name that the input hasn't got), each file's rows in a hash order.

    A shard's rows are dealt to several tasks by their hash, so that none holds a whole shard.
    """
    rows = mixed(docs, id_col, shard_col=shard_col, **how)
    dealt = rows.repartition(shard_col, F.pmod(_key(rows[id_col]), F.lit(MOST_BLOCKS)))
    dealt.sortWithinPartitions(shard_col, _key(rows[id_col], F.lit("order")), id_col).write.partitionBy(shard_col).parquet(path)
