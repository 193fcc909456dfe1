"""Grading answers against a deck of part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import matcher
from granary.plans.query import Registry
from granary.session import table

R = Registry()


def cards(spark, sf_dir):
    """A card per distinct part name; the first word is its genus, and two kinds are asked by genus."""
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("card_id"))
    genus = F.split("p_name", " ")[0]
    return names.select("card_id", F.col("p_name").alias("scientific_name"), F.array().cast("array<string>").alias("common_names"), genus.alias("genus"),
                        F.when(genus.isin("cold", "hot"), "genus").otherwise("species").alias("answer_rank"))


def _asked(spark, sf_dir, answer):
    return cards(spark, sf_dir).select(F.col("card_id").alias("answer_id"), answer.alias("answer"), "card_id")


def _graded(spark, sf_dir, answer):
    return matcher.grade(_asked(spark, sf_dir, answer), matcher.checked_deck(cards(spark, sf_dir)))


_NAME = "scientific_name"
_DECK = """cards AS (SELECT min(p_partkey) AS card_id, p_name, string_split(p_name, ' ')[1] AS genus, string_split(p_name, ' ')[1] IN ('cold', 'hot') AS by_genus FROM part GROUP BY p_name),
full_names AS (SELECT card_id, genus, by_genus, p_name AS name FROM cards UNION SELECT card_id, genus, by_genus, genus FROM cards WHERE by_genus),
words AS (SELECT *, array_to_string(list_sort(list_distinct(string_split(name, ' '))), ' ') AS toks FROM full_names)"""


@R.query(f"WITH {_DECK} SELECT card_id AS answer_id, card_id, 'correct' AS outcome, card_id AS matched_id, 1::INT AS level, NULL::BIGINT AS confused_with, 0::INT AS edit_distance FROM cards")
def grade_exact(spark, sf_dir):
    return _graded(spark, sf_dir, F.upper(_NAME))


@R.query(f"WITH {_DECK} SELECT card_id AS answer_id, card_id, 'correct' AS outcome, card_id AS matched_id, 2::INT AS level, NULL::BIGINT AS confused_with, NULL::INT AS edit_distance FROM cards")
def grade_token(spark, sf_dir):
    words = F.split(_NAME, " ")
    return _graded(spark, sf_dir, F.concat_ws(" ", F.lit("wild"), words[1], words[0]))


_FITS = """asked AS (SELECT card_id, genus, by_genus, {answer} AS answer FROM cards),
near AS (SELECT a.card_id, a.genus, a.by_genus, w.card_id AS other, w.genus AS other_genus, w.by_genus AS other_by_genus, damerau_levenshtein(a.answer, w.name) AS d
  FROM asked a JOIN full_names w ON damerau_levenshtein(a.answer, w.name) <= greatest(1, length(w.name) // 6)),
own AS (SELECT card_id, min(d) AS d FROM near WHERE card_id = other GROUP BY 1),
rivals AS (SELECT n.card_id, n.other, min(n.d) AS d FROM near n LEFT JOIN own o USING (card_id)
  WHERE n.other <> n.card_id AND (o.d IS NULL OR (n.d <= o.d AND NOT (n.by_genus AND n.other_by_genus AND n.genus = n.other_genus))) GROUP BY 1, 2),
top AS (SELECT card_id, first(other ORDER BY d, other) AS confused_with FROM rivals GROUP BY 1)
SELECT a.card_id AS answer_id, a.card_id, CASE WHEN o.d IS NOT NULL AND t.confused_with IS NULL THEN 'correct' ELSE 'wrong' END AS outcome,
  CASE WHEN o.d IS NOT NULL AND t.confused_with IS NULL THEN a.card_id END AS matched_id, CASE WHEN o.d IS NOT NULL THEN 3::INT END AS level, t.confused_with, o.d::INT AS edit_distance
FROM asked a LEFT JOIN own o USING (card_id) LEFT JOIN top t USING (card_id)"""


@R.query(f"WITH {_DECK}, {_FITS.format(answer='p_name || chr(122)')}")
def grade_misspelling(spark, sf_dir):
    """One letter too many."""
    return _graded(spark, sf_dir, F.concat(_NAME, F.lit("z")))


@R.query(f"WITH {_DECK}, {_FITS.format(answer=chr(39) + 'z' + chr(39) + ' || substr(p_name, 2)')}")
def confusion_guard(spark, sf_dir):
    """Another first letter: names that differ in it alone are as near as the card's own."""
    return _graded(spark, sf_dir, F.concat(F.lit("z"), F.expr(f"substring({_NAME}, 2)")))


@R.query(f"""WITH {_DECK} SELECT card_id AS answer_id, card_id, CASE WHEN by_genus THEN 'correct' ELSE 'partial' END AS outcome, card_id AS matched_id, 1::INT AS level, NULL::BIGINT AS confused_with,
CASE WHEN by_genus THEN 0::INT END AS edit_distance FROM cards""")
def partial_credit(spark, sf_dir):
    """The genus alone."""
    return _graded(spark, sf_dir, F.col("genus"))


@R.query("""WITH c AS (SELECT min(p_partkey) AS card_id, p_name, string_split(p_name, ' ')[2] AS common FROM part GROUP BY p_name),
r AS (SELECT a.card_id, min(b.card_id) AS confused_with FROM c a JOIN c b ON a.common = b.common AND a.card_id <> b.card_id GROUP BY 1)
SELECT card_id AS answer_id, card_id, CASE WHEN confused_with IS NULL THEN 'correct' ELSE 'ambiguous' END AS outcome, card_id AS matched_id, 1::INT AS level, confused_with, 0::INT AS edit_distance FROM c LEFT JOIN r USING (card_id)""")
def ambiguous_names(spark, sf_dir):
    """A common name that several cards share."""
    by_name = cards(spark, sf_dir).withColumn("answer_rank", F.lit("species")).withColumn("common_names", F.array(F.split(_NAME, " ")[1]))
    asked = by_name.select(F.col("card_id").alias("answer_id"), F.split(_NAME, " ")[1].alias("answer"), "card_id")
    return matcher.grade(asked, matcher.build_deck(by_name))


@R.query(f"WITH {_DECK} SELECT card_id, name AS accepted, CASE WHEN by_genus AND name = genus THEN 'full' ELSE kind END AS kind FROM (SELECT card_id, genus, by_genus, p_name AS name, unnest(['full', 'scientific']) AS kind FROM cards UNION ALL SELECT card_id, genus, by_genus, genus, 'partial' FROM cards)")
def deck_answers(spark, sf_dir):
    return matcher.build_deck(cards(spark, sf_dir)).select("card_id", "accepted", "kind")


_WIDE = """cards AS (SELECT min(p_partkey) AS card_id, lower(p_name || ' ' || p_brand) AS p_name, string_split(any_value(part.p_name), ' ')[1] AS genus, false AS by_genus FROM part GROUP BY 2),
full_names AS (SELECT card_id, genus, by_genus, p_name AS name FROM cards)"""


@R.query(f"WITH {_WIDE}, {_FITS.format(answer='p_name || chr(122)')}")
def deck_scan(spark, sf_dir):
    """Every name of every brand as a card, and as an answer with one letter too many against the whole deck."""
    name = F.concat_ws(" ", "p_name", "p_brand")
    wide = table(spark, sf_dir, "part").groupBy(name.alias("scientific_name")).agg(F.min("p_partkey").alias("card_id"))
    wide = wide.select("card_id", "scientific_name", F.array().cast("array<string>").alias("common_names"), F.split("scientific_name", " ")[0].alias("genus"), F.lit("species").alias("answer_rank"))
    asked = wide.select(F.col("card_id").alias("answer_id"), F.concat("scientific_name", F.lit("z")).alias("answer"), "card_id")
    return matcher.grade(asked, matcher.checked_deck(wide))


# Fixed values, from the published rules of Double Metaphone: the words of part names, another spelling of each, the word's two codes and the spelling's.
SOUNDS = (
    ("anvil", "anfill", "ANFL", "", "ANFL", ""), ("blue", "bloo", "PL", "", "PL", ""), ("bolt", "pollt", "PLT", "", "PLT", ""), ("cold", "kollt", "KLT", "", "KLT", ""),
    ("gear", "jeer", "JR", "KR", "JR", "AR"), ("gizmo", "jizzmo", "JSM", "KSM", "JSM", "ASM"), ("hot", "hott", "HT", "", "HT", ""), ("large", "larj", "LRJ", "LRK", "LRJ", "LR"),
    ("new", "nu", "N", "NF", "N", ""), ("old", "olld", "ALT", "", "ALT", ""), ("plate", "playt", "PLT", "", "PLT", ""), ("red", "wred", "RT", "", "RT", ""),
    ("ring", "wring", "RNK", "", "RNK", ""), ("rod", "rodd", "RT", "", "RT", ""), ("small", "smawl", "SML", "XML", "SML", "XML"), ("widget", "wijjet", "AJT", "FJT", "AJT", "FJT"),
)
_SOUNDS = "sounds(word, spelled, c1, c2, s1, s2) AS (VALUES " + ", ".join(map(str, SOUNDS)) + ")"
_ALIKE = "list_has_any(list_filter([{a}.{x}1, {a}.{x}2], lambda c: c <> ''), list_filter([{b}.c1, {b}.c2], lambda c: c <> ''))"


@R.query(f"WITH {_SOUNDS}, w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part) SELECT word, c1 AS code, c2 AS second FROM sounds JOIN w USING (word)")
def phonetic_codes(spark, sf_dir):
    """The codes of every word of a name; the second is empty where there is one only."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    codes = X.phonetic_codes(F.col("word"))[0]
    return words.select("word", codes[0].alias("code"), F.coalesce(F.get(codes, F.lit(1)), F.lit("")).alias("second"))


@R.query(f"""WITH {_SOUNDS}, w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part), s AS (SELECT * FROM sounds JOIN w USING (word))
SELECT a.spelled AS answer, b.word, {_ALIKE.format(a='a', x='s', b='b')} AS alike FROM s a JOIN s b ON left(a.word, 1) = left(b.word, 1)""")
def sound_alikes(spark, sf_dir):
    """Other spellings against the words of the same first letter: alike if any of their codes is the same."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    spelled = F.create_map(*[F.lit(x) for w, other, *_ in SOUNDS for x in (w, other)])
    a, b = words.select(F.left("word", F.lit(1)).alias("first"), spelled[F.col("word")].alias("answer")), words.select(F.left("word", F.lit(1)).alias("initial"), "word")
    met = a.join(b, F.col("first") == F.col("initial"))
    return met.select("answer", "word", X.sounds_alike(X.phonetic_codes(F.col("answer")), X.phonetic_codes(F.col("word"))).alias("alike"))


@R.query(f"""WITH {_SOUNDS}, {_DECK},
said AS (SELECT card_id, genus, by_genus, a.c1 AS a1, a.c2 AS a2, a.s1 AS x1, a.s2 AS x2, b.c1 AS b1, b.c2 AS b2, b.s1 AS y1, b.s2 AS y2
  FROM cards JOIN sounds a ON a.word = string_split(p_name, ' ')[1] JOIN sounds b ON b.word = string_split(p_name, ' ')[2]),
rivals AS (SELECT m.card_id, min(r.card_id) AS confused_with FROM said m JOIN said r ON m.card_id <> r.card_id AND NOT (m.by_genus AND r.by_genus AND m.genus = r.genus)
  AND list_has_any(list_filter([m.x1, m.x2], lambda c: c <> ''), list_filter([r.a1, r.a2], lambda c: c <> ''))
  AND list_has_any(list_filter([m.y1, m.y2], lambda c: c <> ''), list_filter([r.b1, r.b2], lambda c: c <> '')) GROUP BY 1)
SELECT s.card_id AS answer_id, s.card_id, CASE WHEN confused_with IS NULL THEN 'correct' ELSE 'wrong' END AS outcome, CASE WHEN confused_with IS NULL THEN s.card_id END AS matched_id,
  4::INT AS level, confused_with, NULL::INT AS edit_distance FROM said s LEFT JOIN rivals USING (card_id)""")
def grade_sounds(spark, sf_dir):
    """Answers that only sound like their card: too many edits away, but word for word of one sound; a rival that sounds alike blocks them."""
    spelled, words = F.create_map(*[F.lit(x) for w, other, *_ in SOUNDS for x in (w, other)]), F.split(_NAME, " ")
    return _graded(spark, sf_dir, F.concat_ws(" ", spelled[words[0]], spelled[words[1]]))
