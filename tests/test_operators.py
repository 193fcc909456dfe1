import random

import pytest
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import claims, constraints, deck, ledger, matcher, nested, promote, sampling, stats, store


def test_ranked_prefix_ends_at_the_row_that_fills_the_limit(spark):
    rnd = random.Random(1)
    reasons = [rnd.choice([None, None, "x", "y"]) for _ in range(500)]
    df = spark.createDataFrame([(7 * k + 3, r) for k, r in enumerate(reasons)], "ord long, reason string").repartition(7)
    for limit in (0, 1, 40, 10_000):
        want, kept = [], 0
        for k, r in enumerate(reasons):
            if kept >= limit:
                break
            want.append(7 * k + 3)
            kept += r is None
        assert sorted(x.ord for x in deck.ranked_prefix(df, "ord", "reason", limit).collect()) == want


def test_ledger(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "id long, reason string")
    kept, dropped = ledger.split(df)
    assert ledger.partition_faults(df, kept, dropped, "id").count() == 0
    assert [x.id for x in ledger.partition_faults(df, kept.filter("id = 1"), dropped.union(dropped), "id").orderBy("id").collect()] == [2, 3]
    assert {(x.reason, x.n) for x in ledger.zero_filled(dropped, ("a", "b")).collect()} == {("a", 1), ("b", 0)}


def _round_robin(items, cap=2, most=8):
    out, owners = [], {}
    pools = {b: sorted(i for i in items if i[1] == b) for b in "ABCD"}
    while len(out) < most:
        before = len(out)
        for b in "ABCD":
            while len(out) < most and pools[b]:
                i = pools[b].pop(0)
                if owners.get(i[2], 0) < cap:
                    owners[i[2]] = owners.get(i[2], 0) + 1
                    out.append(i[0])
                    break
        if len(out) == before:
            break
    return out


def test_round_robin_capped(spark):
    rnd, rows, want = random.Random(3), [], {}
    for g in range(80):
        items = [(i, rnd.choice("ABCD"[: rnd.randint(1, 4)]), rnd.randint(0, rnd.choice([1, 3, 9]))) for i in rnd.sample(range(1000), rnd.randint(1, 90))]
        rows += [(g, *i) for i in items]
        want[g] = _round_robin(items)
    df = spark.createDataFrame(rows, "g long, item long, b string, o long")
    got = {r.g: [x.i for x in r.chosen] for r in sampling.round_robin_capped(df, "g", "b", "o", "item").collect()}
    assert got == want


def test_fusion(spark):
    rows = [(1, "n", "high", "n"), (2, "n", "medium", "n"), (3, "n", "high", "i"), (4, None, None, "i"), (5, "i", "high", None), (6, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a string, c string, b string")
    ref = lambda n: F.array(F.struct(F.lit(n).alias("name")))
    df = df.withColumn("x", F.struct(F.col("a").alias("value"), F.col("c").alias("confidence"), ref("first").alias("sources")))
    df = df.withColumn("y", F.struct(F.col("b").alias("value"), F.lit("high").alias("confidence"), ref("second").alias("sources")))
    got = {r.id: (r.outcome, r.value, r.confidence, [s.name for s in r.sources] if r.sources else None, r.reason) for r in df.select("id", *[c.alias(k) for k, c in claims.fuse("x", "y").items()]).collect()}
    assert got == {
        1: ("agreement", "n", "high", ["first", "second"], None), 2: ("agreement", "n", "medium", ["first", "second"], None), 3: ("conflict", None, None, None, "source_conflict"),
        4: ("single_source", "i", "medium", ["second"], None), 5: ("single_source", "i", "medium", ["first"], None), 6: ("no_source", None, None, None, "no_nativity_source"),
    }


def test_consensus_counts_a_missing_value(spark):
    rows = [(1, "A", "n"), (1, "B", "n"), (2, "A", "n"), (2, "B", None), (3, "B", None), (3, "C", None), (4, "B", "n"), (4, "A", "i")]
    got = {r.id: (r.symbol, r.value, r.n_targets, r.reason) for r in claims.consensus(spark.createDataFrame(rows, "id long, s string, v string"), "id", "s", "v").collect()}
    assert got == {1: ("A", "n", 2, None), 2: ("A", None, 2, "ambiguous_match"), 3: ("B", None, 2, "no_status"), 4: ("A", None, 2, "ambiguous_match")}


def test_last_status_of_a_region_wins(spark):
    rows = [("GERO", "L48", "I", 0), ("GERO", "L48", "N", 1), ("GERO", "AK", "N", 2)]
    got = claims.last_wins(spark.createDataFrame(rows, "symbol string, region string, status string, pos int"), ["symbol", "region"], "pos")
    assert {(r.region, r.status) for r in got.collect()} == {("L48", "N"), ("AK", "N")}


def test_scope_guard(spark):
    df = spark.createDataFrame([("n", 29, 29), ("n", 97394, 40), ("n", None, 29)], "v string, answered int, asked int")
    got = [tuple(r.s) for r in df.select(claims.scoped(F.col("v"), F.col("answered"), F.col("asked")).alias("s")).collect()]
    assert got == [("n", None), (None, "place_not_state_scoped"), (None, "place_not_state_scoped")]


def test_constraints_report_together(spark):
    images = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "h string")
    taxa = spark.createDataFrame([(1, "a"), (1, "b"), (2, "q")], "id long, h string")
    got = constraints.all_of(constraints.unique(images, "h", "dup"), constraints.references(taxa, "h", images, "h", "dangling"), constraints.references(images, "h", taxa, "h", "orphan"))
    assert {tuple(r) for r in got.collect()} == {("dup", "b"), ("dangling", "q"), ("orphan", "z")}
    xor = spark.createDataFrame([(1, "v", None), (2, None, "r"), (3, "v", "r"), (4, None, None)], "id long, claim string, reason string")
    assert {r.key for r in constraints.exactly_one(xor, ["claim", "reason"], "id", "xor").collect()} == {"3", "4"}
    json = spark.createDataFrame([('{"a": 1, "zz": 2}',)], "j string")
    assert json.select(constraints.unknown_keys(F.col("j"), ["a", "b"]).alias("x")).first().x == ["zz"]


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 16, 26, 36, 59])
def test_nearest_rank(spark, n):
    rnd = random.Random(n)
    values = [rnd.randint(0, 9) for _ in range(n)]
    for fraction in (0.1, 0.5, 0.9):
        got = stats.nearest_rank(spark.createDataFrame([(1, v) for v in values], "g int, v int"), ["g"], "v", fraction, "x").first().x
        assert got == sorted(values)[round(fraction * (n - 1))]


def test_store(spark):
    rows = store.addressed(spark.createDataFrame([("a",), ("a",), ("b",)], "t string"), "t")
    fresh = store.new_contents(rows, rows.filter("t = 'b'"))
    assert [r.t for r in fresh.collect()] == ["a"] and fresh.first().shard == fresh.first().sha256[:2]
    assert store.garbage(rows, rows.filter("t = 'a'")).count() == 1
    wanted = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "g long, i string")
    assert {r.g: r.reuse for r in store.reusable(wanted, spark.createDataFrame([(1, "x"), (1, "y"), (1, "old")], "g long, i string"), "g", "i").collect()} == {1: True, 2: False}


def test_promotion(spark):
    taxa = spark.createDataFrame([(k,) for k in range(5)], "id long")
    out = promote.promote(taxa, "id", taxa.filter("id = 0"), spark.createDataFrame([(0, "n"), (1, "n")], "id long, value string"), spark.createDataFrame([(2, "source_conflict")], "id long, reason string"))
    assert {r.id: (r.decision, r.reason) for r in out.collect()} == {0: ("unmatched", "excluded"), 1: ("promoted", None), 2: ("unmatched", "source_conflict"), 3: ("unmatched", "no_claim"), 4: ("unmatched", "no_claim")}


def test_projection(spark):
    body = '{"total_results": 9, "results": [{"id": 1, "name": "Michigan", "admin_level": 10, "ancestor_place_ids": [1, 29], "x": 5}, 7, {"id": 2, "name": "Michigan", "admin_level": 100}]}'
    p = spark.createDataFrame([(body,), ('{"a": 1}',)], "b string").select(nested.project(F.col("b"), "places_autocomplete").alias("p"))
    first, second = (r.p for r in p.collect())
    assert first.total_results == 9 and len(first.results) == 3 and first.results[0].id == 1 and second.results == [] and second.total_results is None
    assert p.select(nested.state_place(F.col("p.results"), "Michigan").alias("x")).first().x == 1
    photos = spark.sql("select array(named_struct('id', 1, 'license_code', cast(null as string)), named_struct('id', 2, 'license_code', 'CC-BY')) p")
    assert tuple(photos.select(nested.usable_photo(F.col("p")).alias("x")).first().x) == (2, "cc-by")
    rows = spark.sql("select 'A' s, 'n' n, '' a, '' y union all select 'A', 'n', 'B', null union all select '', 'n', '', ''")
    got = [r.x for r in rows.select(nested.plant_record(*(F.col(c) for c in "snay")).alias("x")).collect()]
    assert got[0].is_synonym is False and got[1].is_synonym is True and got[2] is None


CARDS = [
    (1, "Acer saccharum", ["sugar maple"], "Acer", "species"), (2, "Acer saccharinum", ["silver maple", "soft maple"], "Acer", "species"),
    (3, "Rubus idaeus", ["red raspberry"], "Rubus", "genus"), (4, "Rubus allegheniensis", ["common blackberry"], "Rubus", "genus"),
    (5, "Quercus alba", ["white oak"], "Quercus", "species"), (6, "Ambrosia trifida", ["giant ragweed", "buffalo weed"], "Ambrosia", "species"),
    (7, "Ambrosia artemisiifolia var. elatior", ["common ragweed"], "Ambrosia", "species"), (8, "Monarda fistulosa", ["wild bergamot", "bee balm"], "Monarda", "species"),
    (9, "Monarda didyma", ["bee balm"], "Monarda", "species"), (10, "Rubus", [], "Rubus", "genus"), (11, "Oaka prima", ["quercus"], "Oaka", "species"),
]


def _expected(answer, card_id):
    """The rules one card at a time."""
    deck = {}
    for i, name, commons, genus, rank in CARDS:
        two = " ".join(name.split()[:2])
        scientific = {X.normalize_text(x) for x in (name, two)}
        full = scientific | {X.normalize_text(c) for c in commons} | ({genus.lower()} if rank == "genus" else set())
        deck[i] = dict(full=full, scientific=scientific, partial={genus.lower()} if rank == "species" else set(), genus=genus.lower(), rank=rank)
    from granary.functions.phonetic import double_metaphone

    def tokens(t):
        return frozenset(w for w in t.split() if w not in X.STOPWORDS) or frozenset(t.split())

    def codes(t):
        return [{c for c in double_metaphone(w) if c} for w in t.split()]

    def best(a, names, scientific):
        if a in names:
            return 1, 0
        if any(tokens(a) == tokens(n) for n in names):
            return 2, 0
        near = [d for n in names if (d := X.edits_within(a, n, max(len(a), len(n)))) <= max(1, len(n) // 6)]
        if near:
            return 3, min(near)
        return (4, 0) if any(len(codes(a)) == len(codes(n)) and all(x & y for x, y in zip(codes(a), codes(n))) for n in scientific) else None

    a, me = X.normalize_text(answer), deck[card_id]
    if not a:
        return "wrong", None, None, None, None
    full, partial = best(a, me["full"], me["scientific"]), best(a, me["partial"], set())
    mode, granted = ("full", full) if full else ("partial", partial) if partial else ("report", None)
    rivals = []
    for i, other in deck.items():
        both = me["rank"] == other["rank"] == "genus" and me["genus"] == other["genus"]
        if i == card_id or mode != "report" and both or mode == "partial" and me["genus"] == other["genus"]:
            continue
        fit = best(a, other["full"], other["scientific"])
        if fit and (granted is None or fit <= granted):
            rivals.append((*fit, i))
    top = min(rivals)[2] if rivals else None
    if mode == "report":
        return "wrong", None, None, top, None
    distance = granted[1] if granted[0] == 3 else None
    if mode == "full" and granted[0] == 1:
        return ("ambiguous" if top else "correct"), card_id, 1, top, 0
    if top:
        return "wrong", None, granted[0], top, distance
    return ("correct" if mode == "full" else "partial"), card_id, granted[0], None, distance


def test_grading(spark):
    said = ["Sugar Maple", "acer sacharum", "acer saccharnum", "maple sugar", "acer", "rubus", "rubus idaeus", "common blackberry", "kwerkus alba", "bee balm", "bergamot", "giant ragweed", "ragweed",
            "quercus", "querkus", "monarda", "monarda fistulosa", "red rasberry", "...", "", "nothing like it", "ambrosia artemisiifolia", "oak white", "wite oak"]
    asked = [(k * 100 + c[0], a, c[0]) for k, a in enumerate(said) for c in CARDS]
    cards = spark.createDataFrame(CARDS, "card_id long, scientific_name string, common_names array<string>, genus string, answer_rank string")
    got = matcher.grade(spark.createDataFrame(asked, "answer_id long, answer string, card_id long"), matcher.build_deck(cards)).collect()
    assert len(got) == len(asked)
    for r in got:
        answer = said[(r.answer_id - r.card_id) // 100]
        assert (r.outcome, r.matched_id, r.level, r.confused_with, r.edit_distance) == _expected(answer, r.card_id), (answer, r.card_id)


@pytest.mark.parametrize("off", [0.01, -0.4])
def test_nearest_rank_equals_sorting(spark, monkeypatch, off):
    """Groups of all sizes, ties, nulls and a group with most rows; a bracket that misses falls back on counting."""
    from granary.operators import stats

    monkeypatch.setattr(stats, "OFF", off)
    monkeypatch.setattr(stats, "SKETCH", 8 if off > 0 else 2000)
    rnd = random.Random(6)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([rnd.random(), float(rnd.randint(0, 3)), None])) for _ in range(500)] + [("hot", rnd.random() * 1e6) for _ in range(6000)] + [("one", 3.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for fraction in (0.0, 0.1, 0.5, 0.99, 1.0):
        want = {}
        for g in {g for g, _ in rows}:
            values = sorted(v for k, v in rows if k == g and v is not None)
            if values:
                want[g] = values[round(fraction * (len(values) - 1))]
        assert {r.g: r.p for r in stats.nearest_rank(df, ["g"], "v", fraction, "p").collect()} == want
    names = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z")], "g int, v string")
    assert stats.nearest_rank(names, ["g"], "v", 0.5, "p").first().p == "y"


def test_misspellings_equal_comparing_all_pairs(spark):
    from granary.functions.text import edits_within
    from granary.operators import matcher

    rnd = random.Random(12)
    names = {"".join(rnd.choice("abcd ") for _ in range(rnd.randint(1, 26))) for _ in range(150)}
    answers = set()
    for name in sorted(names):
        letters = list(name)
        for _ in range(rnd.randint(0, 5)):
            k = rnd.randrange(len(letters) + 1)
            kind = rnd.randrange(4)
            if kind == 0:
                letters.insert(k, rnd.choice("abcdz"))
            elif kind == 1 and letters:
                letters.pop(min(k, len(letters) - 1))
            elif kind == 2 and letters:
                letters[min(k, len(letters) - 1)] = rnd.choice("abcdz")
            elif k + 1 < len(letters):
                letters[k], letters[k + 1] = letters[k + 1], letters[k]
        answers.add("".join(letters))
    answers -= {""}
    frame = lambda rows, c: spark.createDataFrame([(x,) for x in sorted(rows)], f"{c} string")
    rules = [(lambda c: F.greatest(F.lit(1), F.floor(F.length(c) / 6)).cast("int"), lambda n: max(1, len(n) // 6)), (lambda c: F.lit(0), lambda n: 0), (lambda c: F.lit(3), lambda n: 3)]
    for within, most in rules:
        got = {(r.answer, r.accepted): r.distance for r in matcher.misspelled(frame(answers, "answer"), frame(names, "accepted"), within).collect()}
        assert got == {(a, n): d for a in answers for n in names if (d := edits_within(a, n, most(n))) is not None}


@pytest.mark.parametrize("off", [0.004, -0.05])
def test_prefixes_of_orders_of_several_numbers(spark, monkeypatch, off):
    """Orders that are structs, and a sketch whose bound falls short: then every row is counted."""
    monkeypatch.setattr(deck, "OFF", off)
    rnd = random.Random(15)
    rows = [((page, place), rnd.choice([None, "x"])) for page in range(40) for place in range(30)]
    df = spark.createDataFrame(rows, "ord struct<page:int,place:int>, reason string").repartition(6)
    for limit in (1, 100, 590, 5000):
        want, kept = [], 0
        for at, reason in rows:
            if kept >= limit:
                break
            want.append(at)
            kept += reason is None
        assert sorted(tuple(r.ord) for r in deck.ranked_prefix(df, "ord", "reason", limit).collect()) == want
        assert sorted(tuple(r.ord) for r in deck.short_prefix(df, "ord", "reason", limit).collect()) == want
    bound = deck.prefix_bound(df, "ord", F.col("reason").isNull(), 100)
    assert bound is not None and bound < 39
    assert deck.ranked_prefix(df.limit(0), "ord", "reason", 5).count() == 0


def test_facts_count_keys_of_all_tables_at_once(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2,), (3,), (3,)], "k long")
    said = [constraints.facts(a, ("both", "left", F.col("k")), ("big", "left", F.col("k"), F.col("k") > 1)), constraints.facts(b, ("both", "right", F.col("k")))]
    rules = {"twice": ("both", constraints.repeated()), "twice_right": ("both", constraints.repeated("right")), "left": ("both", constraints.alone("left")), "right": ("both", constraints.alone("right")), "both": ("both", constraints.on_both()), "big": ("big", constraints.alone("left"))}
    assert sorted(map(tuple, constraints.broken(said, rules).collect())) == [("big", "2"), ("both", "2"), ("left", "1"), ("right", "3"), ("twice", "2"), ("twice_right", "3")]
    found = constraints.checks(a, "k", {"small": F.col("k") < 2, "known": F.col("k").isNotNull()}).collect()
    assert sorted((r.constraint, str(r.key)) for r in found) == [("known", "None"), ("small", "2"), ("small", "2"), ("small", "None")]
