"""Grading free-text answers against a deck, with a guard against answers that fit another card as well.

An answer fits a card by the first rule that hits: 1 exact, 2 same words, 3 misspelling, 4 sounds alike
(scientific names only). Rules 1 and 2 are equi-joins. Rules 3 and 4 meet distinct answers and names through
keys that every pair that fits shares: what one edit at most leaves of a part of the name, and the sounds of the first and the last word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import binomial, damerau_levenshtein, edit_threshold, normalize, phonetic_codes, sounds_alike, token_set
from granary.operators import constraints
from granary.session import cut

EXACT, TOKENS, MISSPELLED, SOUNDS = 1, 2, 3, 4


def build_deck(cards: DataFrame) -> DataFrame:
    """card_id, genus, answer_rank, accepted, kind (full, partial or scientific): one row per accepted answer.

    cards: card_id, scientific_name, common_names, genus, answer_rank. A species card fully accepts its names
    and partially its genus; a genus card fully accepts its genus too and nothing partially.
    """
    named = cards.select("card_id", normalize(F.col("genus")).alias("genus"), "answer_rank", "scientific_name", "common_names")
    scientific = F.array(F.col("scientific_name"), binomial(F.col("scientific_name")))
    is_genus = F.col("answer_rank") == "genus"
    entries = F.concat(
        F.transform(scientific, lambda x: F.struct(x.alias("name"), F.lit("full").alias("kind"))),
        F.transform("common_names", lambda x: F.struct(x.alias("name"), F.lit("full").alias("kind"))),
        F.transform(scientific, lambda x: F.struct(x.alias("name"), F.lit("scientific").alias("kind"))),
        F.array(F.struct(F.col("genus").alias("name"), F.when(is_genus, "full").otherwise("partial").alias("kind"))),
    )
    flat = named.select("card_id", "genus", "answer_rank", F.explode(entries).alias("e")).select("card_id", "genus", "answer_rank", "e.name", "e.kind")
    return flat.select("card_id", "genus", "answer_rank", normalize(F.col("name")).alias("accepted"), "kind").filter("accepted <> ''").distinct()


def deck_violations(cards: DataFrame, deck: DataFrame) -> DataFrame:
    """Cards without any full answer, and cards asked by genus that grant partial credit."""
    kinds = deck.groupBy("card_id").agg(F.count_if(F.col("kind") == "full").alias("full"), F.count_if(F.col("kind") == "partial").alias("partial"))
    rows = cards.select("card_id", "answer_rank").join(kinds, "card_id", "left")
    return constraints.all_of(
        constraints.check(rows, F.col("full") > 0, "card_id", "no_full_answer"),
        constraints.check(rows, (F.col("answer_rank") != "genus") | (F.coalesce("partial", F.lit(0)) == 0), "card_id", "partial_credit_by_genus"),
    )


def checked_deck(cards: DataFrame) -> DataFrame:
    """build_deck, or an error that names the first cards that can't be answered."""
    deck = cut(build_deck(cards))
    faults = deck_violations(cards, deck).orderBy("constraint", "key").take(5)
    if faults:
        raise ValueError("; ".join(f"{x['constraint']}: {x['key']}" for x in faults))
    return deck


def _without_one(texts: Column) -> Column:
    """The texts (an array) with each of their letters left out in turn."""
    return F.flatten(F.transform(texts, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))))


def _parts(size: Column, edits: Column) -> Column:
    """(begin, length) of as many parts, as even as can be, of a name of a size as edits are allowed, one at least."""
    many = F.greatest(edits, F.lit(1))
    place = lambda i: F.floor(i * size / many).cast("int")
    return F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.struct(place(i).alias("begin"), (place(i + 1) - place(i)).alias("length")))


def misspelled(answers: DataFrame, names: DataFrame, within) -> DataFrame:
    """answer, accepted, distance: pairs at most so many edits apart as within(name) says, never more than the name is long.

    answers and names: one column each, answer and accepted, of distinct strings. A name has as many parts as edits are allowed. An
    edit lies in one part, a swap over a boundary in two, and there is one boundary fewer: so one part has one edit at
    most. It stands in the answer, shifted by no more than the number of edits, up to a letter left out on either side. Pairs
    meet by the part's number and what is left of it.
    """
    sized = names.withColumn("most", within(F.col("accepted"))).withColumn("size", F.length("accepted"))
    kinds = F.broadcast(cut(sized.select("size", "most").distinct()))  # a line for each length there is
    own = F.transform(_parts(F.col("size"), F.col("most")), lambda p: F.array(F.substring("accepted", p["begin"] + 1, p["length"])))
    flat = F.flatten(F.transform(own, lambda w, i: F.transform(F.array_distinct(F.concat(w, F.when(F.col("most") > 0, _without_one(w)).otherwise(F.slice(w, 1, 0)))), lambda v: F.struct(i.alias("nth"), v.alias("left")))))
    keyed = sized.select("accepted", "most", "size", F.explode(flat).alias("k")).select("accepted", "most", "size", "k.nth", "k.left")

    # few rows become many: they are dealt out before, as Spark would leave few bytes in one task
    tasks = int(answers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = answers.withColumn("n", F.length("answer")).repartition(tasks)
    lengths = kinds.withColumn("places", _parts(F.col("size"), F.col("most"))).withColumn("ns", F.expr("sequence(greatest(size - most, 0), size + most)"))
    lengths = lengths.select(F.col("most").alias("edits"), F.explode("ns").alias("n"), F.posexplode("places").alias("nth", "p"))
    # names of several lengths may allow the same edits: their parts' places are looked at together
    spans = lengths.groupBy("n", "edits", "nth", "p.length").agg(F.min("p.begin").alias("first"), F.max("p.begin").alias("last"))
    asked = asked.join(F.broadcast(spans), "n")

    def windows(more: int):
        """What stands in the answer where the part may, some letters longer or shorter than it."""
        width = F.col("length") + more
        first, last = F.greatest(F.col("first") - F.col("edits"), F.lit(0)), F.least(F.col("last") + F.col("edits"), F.col("n") - width)
        begins = F.when((width >= 0) & (last >= first), F.sequence(first, F.greatest(last, first))).otherwise(F.array().cast("array<int>"))
        return F.transform(begins, lambda b: F.substring("answer", b + 1, width))

    same = windows(0)
    left = F.when(F.col("edits") > 0, F.concat(same, _without_one(same), windows(-1), _without_one(windows(1)))).otherwise(same)
    asked = asked.select("answer", "edits", "nth", F.explode(F.array_distinct(left)).alias("left"))
    near = F.expr("levenshtein(answer, accepted, 2 * most) >= 0")
    met = asked.join(keyed.withColumnsRenamed({"most": "edits"}).withColumn("most", F.col("edits")), ["edits", "nth", "left"])
    met = met.filter((F.abs(F.length("answer") - F.col("size")) <= F.col("most")) & near).select("answer", "accepted", "most").distinct()
    return met.withColumn("distance", damerau_levenshtein(F.col("answer"), F.col("accepted"), F.col("most"))).filter("distance <= most").select("answer", "accepted", "distance")


def _by_sound(rows: DataFrame, codes: str) -> DataFrame:
    """rows with sound: the number of words and one code each of the first and the last of them, for all such pairs."""
    last = F.try_element_at(codes, F.lit(-1))
    pairs = F.flatten(F.transform(F.try_element_at(codes, F.lit(1)), lambda a: F.transform(last, lambda b: F.struct(F.size(codes).alias("n"), a.alias("first"), b.alias("last")))))
    return rows.withColumn("sound", F.explode(F.array_distinct(pairs)))


def candidates(answers: DataFrame, deck: DataFrame) -> DataFrame:
    """answer, card_id, as_partial, level, distance: the best fit of every normalised answer to every card it fits.

    answers: one column, answer, distinct and not empty.
    """
    names = deck.filter("kind <> 'scientific'").select("card_id", "accepted", (F.col("kind") == "partial").alias("as_partial"))
    fits = [answers.join(names, F.col("answer") == F.col("accepted")).select("answer", "card_id", "as_partial", F.lit(EXACT).alias("level"), F.lit(0).alias("distance"))]

    words = answers.withColumn("words", F.array_join(token_set(F.col("answer")), " ")).filter("words <> ''")
    named = names.withColumn("name_words", F.array_join(token_set(F.col("accepted")), " "))
    fits.append(words.join(named, F.col("words") == F.col("name_words")).select("answer", "card_id", "as_partial", F.lit(TOKENS), F.lit(0)))

    near = misspelled(answers, names.select("accepted").distinct(), edit_threshold)
    fits.append(near.join(names, "accepted").select("answer", "card_id", "as_partial", F.lit(MISSPELLED), "distance"))

    heard = _by_sound(answers.withColumn("codes", phonetic_codes(F.col("answer"))), "codes")
    said = deck.filter("kind = 'scientific'").select(F.col("card_id"), phonetic_codes(F.col("accepted")).alias("name_codes"))
    alike = heard.join(_by_sound(said, "name_codes"), "sound").filter(sounds_alike(F.col("codes"), F.col("name_codes")))
    fits.append(alike.select("answer", "card_id", F.lit(False), F.lit(SOUNDS), F.lit(0)))

    every = fits[0]
    for x in fits[1:]:
        every = every.union(x)
    best = F.min(F.struct("level", "distance"))
    return every.groupBy("answer", "card_id", "as_partial").agg(best.alias("fit")).select("answer", "card_id", "as_partial", "fit.level", "fit.distance")


def grade(asked: DataFrame, deck: DataFrame) -> DataFrame:
    """asked (answer_id, answer, card_id) with outcome, matched_id, level, confused_with, edit_distance.

    An exact full answer is correct, or ambiguous if it is another card's exact answer too. Any other
    credit is refused if a rival card fits at least as well: ties block. Cards that ask for the same genus
    are no rivals; for partial credit no card of the genus is. If nothing fits, the strongest rival is named.
    """
    deck = cut(deck)  # read by every rule; the UDFs in it run once
    cards = deck.select("card_id", "genus", "answer_rank").distinct()
    rows = asked.withColumn("normal", normalize(F.col("answer")))
    found = cut(candidates(cut(rows.select(F.col("normal").alias("answer")).filter("answer <> ''").distinct()), deck))

    own = found.groupBy("answer", "card_id").agg(
        F.min(F.when(~F.col("as_partial"), F.struct("level", "distance"))).alias("full"),
        F.min(F.when(F.col("as_partial"), F.struct("level", "distance"))).alias("partial"),
    )
    rows = rows.join(cards, "card_id")
    rows = rows.join(own.withColumnsRenamed({"answer": "normal"}), ["normal", "card_id"], "left")
    mode = F.when(F.col("full").isNotNull(), "full").when(F.col("partial").isNotNull(), "partial").otherwise("report")
    rows = rows.withColumn("mode", mode).withColumn("granted", F.coalesce("full", "partial"))

    other = cards.select(F.col("card_id").alias("rival"), F.col("genus").alias("rival_genus"), F.col("answer_rank").alias("rival_rank"))
    rivals = found.filter("NOT as_partial").select(F.col("answer").alias("normal"), F.col("card_id").alias("rival"), F.struct("level", "distance").alias("fit")).join(other, "rival")
    same_answer = (F.col("answer_rank") == "genus") & (F.col("rival_rank") == "genus") & (F.col("genus") == F.col("rival_genus"))
    counts = (F.col("mode") == "report") | ~same_answer & ((F.col("mode") == "full") | (F.col("genus") != F.col("rival_genus")))
    blocks = (F.col("mode") == "report") | (F.col("fit") <= F.col("granted"))
    met = rows.select("answer_id", "normal", "card_id", "mode", "granted", "genus", "answer_rank").join(rivals, "normal")
    met = met.filter((F.col("rival") != F.col("card_id")) & counts & blocks)
    strongest = met.groupBy("answer_id").agg(F.min(F.struct(F.col("fit.level"), F.col("fit.distance"), "rival")).alias("top"))

    out = rows.join(strongest, "answer_id", "left")
    level, exact, blocked = F.col("granted.level"), (F.col("mode") == "full") & (F.col("granted.level") == EXACT), F.col("top").isNotNull()
    outcome = F.when(F.col("mode") == "report", "wrong").when(exact, F.when(blocked, "ambiguous").otherwise("correct")).when(blocked, "wrong").when(F.col("mode") == "full", "correct").otherwise("partial")
    out = out.withColumn("outcome", outcome)
    return out.select(
        "answer_id", "card_id", "outcome", F.when(F.col("outcome") != "wrong", F.col("card_id")).alias("matched_id"), level.alias("level"), F.col("top.rival").alias("confused_with"),
        F.when(exact, F.lit(0)).when(level == MISSPELLED, F.col("granted.distance")).alias("edit_distance"),
    )


def token_collisions(deck: DataFrame) -> DataFrame:
    """Word sets that full answers of several cards share."""
    words = F.array_join(token_set(F.col("accepted")), " ")
    sets = deck.filter("kind = 'full'").select("card_id", words.alias("words")).distinct()
    return sets.groupBy("words").agg(F.count(F.lit(1)).alias("n_cards")).filter("n_cards > 1")


def pairs_within(names: DataFrame, name: str, tolerance: int) -> DataFrame:
    """a, b, distance: pairs of distinct names at most so many edits apart, met as misspellings are."""
    each = names.select(F.col(name).alias("answer")).distinct()
    met = misspelled(each, each.withColumnRenamed("answer", "accepted"), lambda c: F.lit(tolerance))
    return met.filter("answer < accepted").select(F.col("answer").alias("a"), F.col("accepted").alias("b"), "distance")
