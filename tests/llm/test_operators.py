"""Operators against plain Python: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import os
import random
import re
import zlib
from statistics import NormalDist

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from granary.llm import bpe, common, exact_dedup, html_text, line_dedup, mixing, near_dedup, pieces, quality, sharding, substring_dedup, wavelet
from granary.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, keep_id long, size long, block long, h string, item long, shard int"


def words(rnd, n):
    return [rnd.choice("the of and river stone light cloud ember quiet marsh north vale harbour lantern".split()) + str(rnd.randint(0, 400)) for _ in range(n)]


def corpus(seed=1, n=60):
    """Random documents with exact copies, copies of other white space, near copies and shared lines."""
    rnd, rows = random.Random(seed), []
    shared = [" ".join(words(rnd, 12)) + "." for _ in range(4)]
    for k in range(n):
        base = words(rnd, rnd.choice([1, 3, 7, 30, 80, 200]))
        lines = [" ".join(base[i : i + 11]) + "." for i in range(0, len(base), 11)]
        if k % 5 == 0:
            lines += shared
        text = "\n".join(lines)
        if k % 7 == 3 and rows:
            text = rows[rnd.randrange(len(rows))][1] or ""
        if k % 7 == 5 and rows:
            other = (rows[rnd.randrange(len(rows))][1] or "").split(" ")
            if len(other) > 40:
                other[rnd.randrange(len(other))] = "edited"
            text = " ".join(other)
        if k % 9 == 4:
            text = text.replace(" ", "  \t")
        rows.append((k, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "a", "a", "b", "c", None])))
    rows += [(n, None, "en", "a"), (n + 1, "", None, None), (n + 2, " \n\t ", "en", "b"), (n + 3, "x" * 200_000, "en", "a"), (n + 4, "ab cd " * 40_000, "fr", "a")]
    rows += [rows[2], rows[2]]  # repeated rows
    return rows


def frame(spark, rows):
    full = [(i, t, lang, s, None, False, -1, -5, 7, "h", 1, 2) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(5).cache()


@pytest.fixture(scope="module")
def rows():
    return corpus()


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("most", [0, 250_000])
def test_exact_dedup(docs, rows, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_SENT", most)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_norm(t), []).append((-len(t or ""), i))
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    want = sorted((i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(_norm(t).encode()).hexdigest()) for i, t, *_ in rows for g in [groups[_norm(t)]])
    assert got == want


def test_exact_dedup_separates_colliding_hashes(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("00" * 16))
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_norm(t), []).append((-len(t or ""), i))
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {(i, min(groups[_norm(t)])[1], len(groups[_norm(t)])) for i, t, *_ in rows}


def test_keep_first_keeps_columns(docs, rows):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_norm(t), []).append((-len(t or ""), i))
    assert sorted((_norm(r.text), r.doc_id) for r in kept.collect()) == sorted((x, min(g)[1]) for x, g in groups.items())


REPEATED = [(1, "AAA"), (1, "BB"), (2, "B B"), (5, "zz"), (5, "zz"), (5, "zz"), (None, "AAA"), (None, "q"), (None, "q"), (7, None), (7, ""), (8, " "), (6, "m n"), (6, "mn "), (6, "y")]


def test_keep_first_keeps_one_row_of_every_group(spark):
    docs = spark.createDataFrame([(i, t, {"a": k}) for k, (i, t) in enumerate(REPEATED)], "doc_id long, text string, own map<string,int>")
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.keep_first(docs).collect()), key=repr)
    rest = [x for x in got if x not in ((6, "m n"), (6, "mn "))]
    assert len(got) == len(rest) + 1 and rest == sorted([(1, "AAA"), (2, "B B"), (5, "zz"), (None, "q"), (8, " "), (6, "y")], key=repr)


@pytest.mark.parametrize("most", [0, 250_000])
def test_keep_one_keeps_one_row_of_every_component(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_SENT", most)
    rnd = random.Random(9)
    base = [words(rnd, 60) for _ in range(6)]
    near = [" ".join(["edited", *x[1:]]) for x in base]
    text = [" ".join(x) for x in base]
    rows = [(3, text[0]), (3, text[0]), (3, text[1]), (2, near[1]), (None, near[0]), (None, text[2]), (None, text[2]), (None, near[2]), (9, text[3]), (9, near[3]), (4, text[4]), (4, text[4]), (1, None), (1, ""), (1, " "), (0, text[5]), (5, near[5])]
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, own string, node int")
    got = near_dedup.keep_one(docs).collect()
    by = lambda x: sorted(i for r in got if r.text in (text[x], near[x]) for i in [repr(r.doc_id)])
    assert [by(k) for k in range(6)] == [["3"], ["2"], ["None"], ["9"], ["4"], ["0"]]
    assert sorted(repr(r.text) for r in got if not (r.text or "").strip()) in (["' '", "''"], ["' '", "None"]) and len(got) == 8
    ids = {(r.doc_id, r.n_shingles): r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert ids[None, 56] in (3, None) and ids[2, 56] == 2


def _line_removals(rows):
    """Brute force: distinct documents in id order, windows of three lines with words."""
    seen, gone = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}):
        lines = [(k, x.strip(" \t\n\x0b\x0c\r")) for k, x in enumerate(t.split("\n"))]
        lines = [x for x in lines if x[1]]
        for j in range(len(lines) - 2):
            if seen.setdefault(tuple(x[1] for x in lines[j : j + 3]), (i, j)) != (i, j):
                gone.setdefault(i, set()).update(x[0] for x in lines[j : j + 3])
    return {i: sorted(x) for i, x in gone.items()}


def test_line_dedup(docs, rows):
    want = _line_removals(rows)
    assert {r.doc_id: r.places for r in line_dedup.repeated_lines(docs).collect()} == want
    texts = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    for i, t, *_ in rows:
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want.get(i, ()))
        assert texts[i] == left


def _parts(text):
    """Independent of the operator: (normalised text, begin, end) of lines, and of what a line's sentences make up."""
    edges, found = " \t\r\x0b\x0c.,;:!?…。\"'()[]{}«»“”‘’-！？「」『』（）".replace("{}", ""), []

    def norm(part):
        whole = " ".join(part.casefold().split())
        return whole.strip(edges) or whole

    at = 0
    for line in text.split("\n"):
        begin, at = at, at + len(line) + 1
        if not line.split():
            continue
        found.append((norm(line), begin, begin + len(line)))
        cuts, k = [0], 0
        while k < len(line):
            stop = k
            if line[k] in "。！？":
                while stop < len(line) and line[stop] in "。！？":
                    stop += 1
                while stop < len(line) and line[stop] in "\"')]»”’」』）":
                    stop += 1
                while stop < len(line) and line[stop].isspace():
                    stop += 1
            elif line[k] in ".!?…":
                while stop < len(line) and line[stop] in ".!?…":
                    stop += 1
                while stop < len(line) and line[stop] in "\"')]»”’":
                    stop += 1
                blank = stop
                while blank < len(line) and line[blank].isspace():
                    blank += 1
                stop = blank if blank > stop or blank == len(line) else k
            if stop > k:
                cuts.append(stop)
            k = max(stop, k + 1)
        cuts = sorted({*cuts, len(line)})
        pieces = [(a, b) for a, b in zip(cuts, cuts[1:])]
        if len(pieces) < 2:
            continue

        def long_enough(i, j):
            words = [w for a, b in pieces[i : j + 1] for w in line[a:b].casefold().split()]
            return len(words) >= 8 or sum(map(len, words)) >= 40

        runs = set()
        for i in range(len(pieces)):
            for step in (-1, 1):
                j = i
                while 0 <= j < len(pieces) and not long_enough(min(i, j), max(i, j)):
                    j += step
                if 0 <= j < len(pieces):
                    runs.add((min(i, j), max(i, j)))
        last = {}
        for i, j in sorted(runs):
            a, b = begin + pieces[i][0], begin + pieces[j][1]
            key = norm(text[a:b])
            if (i, j) != (0, len(pieces) - 1) and a >= last.get(key, 0):
                last[key] = b
                found.append((key, a, b))
    return found


def test_substring_dedup(docs, rows):
    """Brute force over the normalised texts of all units themselves, found without the operator's code."""
    rnd = random.Random(18)
    say = lambda n: " ".join(words(rnd, n)).capitalize()
    shared = [f"{say(9)}. {say(2)}! {say(3)}?", f"{say(12)}.", say(2) + ".", "他走了。" * 3, f"“{say(8)}.” {say(1)}…"]
    more = [(100 + k, "\n".join(" ".join(rnd.sample(shared, rnd.randint(1, 4)) + [f"{say(rnd.randint(1, 12))}."] * rnd.randint(0, 2)) for _ in range(4)), "en", "a") for k in range(60)]
    docs, rows = docs.union(frame(docs.sparkSession, more)), [*rows, *more]
    first, spans = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}):
        for key, a, b in _parts(t):
            if key in first:
                spans.setdefault(i, []).append((a, b))
            first.setdefault(key, i)
    want = set()
    for i, found in spans.items():
        merged = []
        for a, b in sorted(found):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want |= {(i, a, b) for a, b in merged}
    got = substring_dedup.removed_spans(docs).collect()
    assert want and {(r.doc_id, r.begin, r.end) for r in got} == want
    texts = {i: t for i, t, *_ in rows}
    left = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()}
    for i, t in texts.items():
        cut = t
        for _, a, b in sorted((x for x in want if x[0] == i), reverse=True):
            cut = cut[:a] + cut[b:]
        assert left[i] == cut


def test_clashing_names(spark):
    line = "one line of quite a few words here\nanother line of several more\nand a third one"
    rows = [(k, f"{line}\nown {k}", [k], "g", 5, 6) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans array<long>, _places string, _gone_id long, text_key long")
    for run in (substring_dedup.without_repeats, line_dedup.without_repeated_lines, exact_dedup.keep_first, near_dedup.keep_one, mixing.mixed, quality.keep_good):
        out = run(docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "_right_source": F.lit(1), "range": F.lit(2)}))
        assert out.columns[:6] == docs.columns and len(out.collect()) <= 9
    assert sorted(r.text for r in line_dedup.without_repeated_lines(docs).collect()) == [f"{line}\nown 0", "own 1", "own 2"]


def test_substring_dedup_finds_a_passage_inside_a_paragraph(spark):
    rnd = random.Random(5)
    sentences = [" ".join(words(rnd, 14)).capitalize() + "." for _ in range(9)]
    passage = " ".join(sentences[3:6])
    rows = [(1, f"{sentences[0]} {passage} {sentences[1]}", "en", "a"), (2, f"{sentences[2]} {passage} {sentences[6]}", "en", "a"), (3, sentences[7], "en", "a")]
    got = substring_dedup.removed_spans(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {2} and {r.first_id for r in got} == {1}
    assert sum(r.end - r.begin for r in got) >= len(passage)


def test_substring_dedup_finds_short_units(spark):
    rnd = random.Random(16)
    a, b, c, d = (" ".join(words(rnd, 12)).capitalize() + "." for _ in range(4))
    passage = f"{a} It rained. So we went. {b} No."
    chinese = "春天的早晨河边的石头上有光。老人慢慢走过安静的桥。孩子们在北边的山谷里找到一盏旧灯笼。"
    rows = [
        (1, f"Les.\n{c} {passage}\n{chinese}", "en", "a"), (2, f"Own line of two.\nLes.\n{d} {passage} Tail it is not.\nIt rained over there.", "en", "a"),
        (3, f"别的话在前面。{chinese}", "zh", "a"), (4, f"{chinese}\nNo. It rained. But {'not here and now ' * 3}", "zh", "a"),
    ]
    left = {r.doc_id: r.text for r in substring_dedup.without_repeats(frame(spark, rows)).collect()}
    assert left[1] == rows[0][1] and left[2] == f"Own line of two.\n\n{d} Tail it is not.\nIt rained over there."
    assert left[3] == "别的话在前面。" and left[4] == rows[3][1].removeprefix(chinese)


def _shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_near_duplicates(docs, rows):
    sets = {i: _shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= 75 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted((i, len(sets[i]), find(i), i == find(i)) for i, *_ in rows)
    assert near_dedup.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("pairs", [30, 500])
def test_near_duplicates_inside_a_large_divided_bucket(spark, pairs):
    """Many texts share a passage at a similarity just under the threshold; pairs of them are closer."""
    rnd = random.Random(12)
    passage, rows, want = words(rnd, 124), [], {}
    for k in range(1000):
        tail = [f"t{k}x{j}" for j in range(22)]
        if k >= 1000 - 2 * pairs and k % 2:
            tail[:4] = rows[-1][1].split()[124:128]
            want[k] = k - 1
        rows.append((k, " ".join(passage + tail), "en", "a"))
    sets = [_shingles(t) for _, t, *_ in rows]
    assert all((100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])) == (want.get(b) == a) for b in range(900, 1000) for a in range(b))
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    found = {r.doc_id: r.component_id for r in got if not r.kept}
    # a pair at the threshold shares no band with a chance of 0.0003
    assert found.items() <= want.items() and len(found) >= 0.99 * pairs


def test_recall_of_links_at_the_threshold():
    rnd, found = random.Random(3), 0
    for _ in range(400):
        common = [rnd.getrandbits(64) for _ in range(150)]
        sets = [np.unique(np.array(common + [rnd.getrandbits(64) for _ in range(25)], np.uint64)) for _ in range(2)]
        a, b = (near_dedup.band_keys(near_dedup.signature(s)) for s in sets)
        found += bool((a == b).any())
    assert found >= 396


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_sharding(docs, rows):
    got = sharding.shard_law(docs).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(24))


def test_sharding_balances_and_splits_a_large_group(spark):
    rnd = random.Random(4)
    rows = [(k, "one text that a third of all rows share" if k % 3 == 0 else " ".join(words(rnd, rnd.randint(5, 30))), "en", "a") for k in range(6000)]
    got = sharding.shard_documents(frame(spark, rows)).collect()
    sizes = np.bincount([r.shard for r in got], weights=[r.size for r in got], minlength=24)
    counts = np.bincount([r.shard for r in got], minlength=24)
    assert sizes.max() / sizes.min() < 1.03 and counts.max() / counts.min() < 1.1


@pytest.mark.parametrize("n", [1500, 9000])
def test_sharding_keeps_groups_that_fit_together(spark, n):
    rnd, rows = random.Random(15), []
    for k in range(20):
        text = " ".join(words(rnd, 20))
        rows += [text] * (n // 60 if k == 0 else 2 + n // 700)
    rows += [" ".join(words(rnd, rnd.randint(10, 30))) for _ in range(n - len(rows))]
    rnd.shuffle(rows)
    got = sharding.shard_documents(frame(spark, [(k, t, "en", "a") for k, t in enumerate(rows)])).collect()
    of = {}
    for r in got:
        of.setdefault(rows[r.doc_id], set()).add(r.shard)
    assert len(of) < len(rows) and all(len(x) == 1 for x in of.values())
    sizes = np.bincount([r.shard for r in got], weights=[r.size for r in got], minlength=24)
    assert sizes.max() / sizes.min() < 1.1


def test_packing_goes_to_the_highest_dot_product():
    items = np.array([[0.5, 0.1], [0.3, 0.3], [0.2, 0.6]])
    assert sharding.pack(items, 2).tolist() == [1, 1, 0]


def _targets(sizes):
    """Reshares excess by weight until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left, open_weight = total - sum(3 * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_mixing(docs, rows):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    sizes = {}
    for i, _, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    target, got = _targets(sizes), mixing.taken_words(docs).collect()
    assert sorted((r.doc_id, r.size, r.source_size) for r in got) == sorted((i, size[i], sizes[s]) for i, _, _, s in rows)
    taken, largest = {}, {}
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert all(target[s] - largest[s] <= taken[s] <= target[s] + 1e-6 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken_words(docs.repartition(3)).collect()))
    mixed = mixing.mixed(docs, shard_col="to_shard")
    assert mixed.columns == [*docs.columns, "to_shard"]
    assert mixed.count() == sum(len(r.placements) for r in got)


@pytest.mark.parametrize("bits", [52, 58, 63])
def test_rows_of_a_block_that_is_taken_in_part(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "RANGE_BITS", bits)
    rnd, rooms, rows = random.Random(17), {"a": 4000, "b": 3, None: 10**9, "c": 900, "d": 0}, []
    for source, room in rooms.items():
        rows += [(source, float(room), rnd.choice([1, 5, 20, 2000]), rnd.getrandbits(64) - 2**63, k) for k in range(400)]
    near = spark.createDataFrame(rows, "source string, room double, size long, key long, id long")
    runs = {r.source: r.runs for r in mixing._chosen(near).collect()}
    for source, room in rooms.items():
        taken = [
            (size, key, i) for s, _, size, key, i in rows if s == source
            and any((r.after is None or (key, i) > tuple(r.after)) and (key, i) <= tuple(r.upto) and size <= r.most for r in runs.get(source) or [])
        ]
        total = sum(x[0] for x in taken)
        assert total <= room and (total >= room - 20 or len(taken) == 400), (source, total)


def test_written_shards_hold_the_mix_in_a_shuffled_order(spark, docs, tmp_path):
    mixing.write_shards(docs, str(tmp_path / "m"))
    got = spark.read.parquet(str(tmp_path / "m")).select("doc_id", "to_shard").collect()
    want = mixing.mixed(docs, shard_col="to_shard").select("doc_id", "to_shard").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len({r.to_shard for r in want}) == mixing.SHARDS
    order = [r.doc_id for r in spark.read.parquet(str(next((tmp_path / "m").rglob("*.parquet")))).select("doc_id").collect()]
    assert set(order) and (len(order) < 5 or order != sorted(order))


def test_targets_of_many_sources(spark):
    rnd = random.Random(6)
    sizes = {f"s{k:03d}": rnd.choice([0, 1, 10, 200, 5000]) for k in range(50)} | {None: 40}
    got = mixing.source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")).collect()
    want = _targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want and sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_tree_deals_exact_quotas_as_a_hypergeometric_draw(spark, monkeypatch):
    quotas = spark.createDataFrame([("a", 40), ("b", 25), (None, 7)], "source string, n int")
    firsts = []
    for seed in range(12):
        monkeypatch.setattr(mixing, "SEED", f"t{seed}")
        got = {r.source: r.quota for r in mixing.shard_quotas(quotas, 4).collect()}
        assert {s: sum(q) for s, q in got.items()} == {"a": 40, "b": 25, None: 7}
        assert [sum(got[s][k] for s in got) for k in range(4)] == [18, 18, 18, 18]
        firsts.append(got["a"][0])
    assert 7 <= np.mean(firsts) <= 13 and len(set(firsts)) > 3  # mean 10, deviation 1.8


def test_bpe(docs, rows):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(open(path, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t, *_ in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN).collect())) == sorted(want)


def test_bpe_on_awkward_texts():
    import tiktoken

    content = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    own, encoder = bpe.encoder(content, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rnd, parts = random.Random(8), ["a", "aa", " ", "  ", "\n", "é", "中", "😀", "12", "!?", "'s", "\t", "　", "\x1c", "\x85", "é", "the", "ing"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        ids, ends = encoder.encode(pa.array([text]))
        assert ids.tolist() == library.encode_ordinary(text) and ends.tolist() == [len(ids)] and bytes(own.decode(ids)[0]) == text.encode()
    assert own.encode_bytes(b"a" * 5000) == library.encode_ordinary("a" * 5000)


@pytest.mark.parametrize(("part_bytes", "most"), [(8_000_000, 500_000), (7, 6), (40, 0)])
def test_pieces_are_the_matches_of_the_pattern(part_bytes, most):
    numbers, rnd = {}, random.Random(5)

    def numbered(found):
        return np.array([numbers.setdefault(x, len(numbers)) for x in found], np.uint32), np.ones(len(found), np.int64)

    by_kind, by_pattern = pieces.PieceEncoder(numbered, most=most, part_bytes=part_bytes), pieces.PieceEncoder(numbered, pieces.BYTE_LEVEL + "|(?!)", most)
    letters = [*"ab1 \n\t''  !.sremtvld'é", "\u3000", "中", "٣", "😀", "\xa0", "½", "\x1c", "\x85", "e\u0301"]
    for _ in range(1500):
        texts = pa.array([rnd.choice([None, "", "".join(rnd.choices(letters, k=rnd.randint(0, 30)))]) for _ in range(rnd.randint(0, 5))], pa.string())
        want = [[numbers.setdefault(x, len(numbers)) for x in regex.findall(pieces.BYTE_LEVEL, t or "")] for t in texts.to_pylist()]
        for encoder in (by_kind, by_pattern):
            ids, ends = encoder.encode(texts)
            assert [x.tolist() for x in np.split(ids, ends)[:-1]] == want and len(ids) == sum(map(len, want))


def test_pieces_of_any_character_are_the_librarys():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    every = [chr(k) for k in (*range(1, 0xD800), *range(0xE000, 0x30000))]
    texts = ["".join(f"a{c}{c}b {c} 1{c}\n{c}" for c in every[k : k + 2000]) for k in range(0, len(every), 2000)]
    ids, ends = wavelet.encoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_patterns_may_cross_blanks():
    found = pieces.PieceEncoder(lambda x: (np.array([len(p) for p in x], np.uint32), np.ones(len(x), np.int64)), r"\w+ \w+|.")
    assert found.encode(pa.array(["ab cd!", None, "x"]))[0].tolist() == [5, 1, 1]


def _library_rows(rows):
    from tokenizers import Tokenizer

    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in sorted(((i, t) for i, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1])):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return want


@pytest.mark.parametrize("shard_tokens", [2_000_000, 300])
def test_wavelet_round_trip(docs, rows, shard_tokens):
    got = wavelet.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), shard_tokens=shard_tokens).collect()
    assert sorted(map(tuple, got)) == sorted(_library_rows(rows))


def test_added_tokens_and_null_ids_in_token_files(spark):
    rows = [(4, "hello <|endoftext|> world", "en", "a"), (None, "b  b", "en", "a"), (2, "<|endoftext|><|endoftext|>", "en", "a"), (3, "<|endoftext|", "en", "a"), (None, None, "en", "a"), (5, " x\n", "en", "a")]
    got = [tuple(r) for r in wavelet.round_trip(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).collect()]
    assert sorted(got, key=repr) == sorted(_library_rows(rows), key=repr)


def test_token_files_answer_counts_places_and_access(spark, tmp_path):
    from tokenizers import Tokenizer

    path, vocabulary = str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(3)
    texts = {k: " ".join(rnd.choices(["the", "cat", "sat", "on", "it"], k=rnd.randint(0, 30))) for k in range(40)}
    library = Tokenizer.from_file(vocabulary)
    ids = {k: [*library.encode(t, add_special_tokens=False).ids, wavelet.END_ID] for k, t in texts.items()}
    wavelet.write_tokens(frame(spark, [(k, t, "en", "a") for k, t in texts.items()]), path, vocabulary, shard_tokens=50)
    cat = library.encode(" cat").ids[0]
    count = sum(x.count(cat) for x in ids.values())
    assert {r.id: r.n for r in wavelet.id_counts(spark, path, [cat, wavelet.END_ID, 77]).collect()} == {cat: count, wavelet.END_ID: 40, 77: 0}
    places = sorted((k, n) for k, x in ids.items() for n, y in enumerate(x) if y == cat)
    assert sorted(map(tuple, wavelet.occurrences(spark, path, cat).collect())) == places
    rows = spark.read.schema(wavelet.FILE).parquet(path).collect()
    assert len(rows) > 3
    for row in rows:
        m, all_ids = wavelet.WaveletMatrix.of_row(row), [y for k in row["doc_ids"] for y in ids[k]]
        assert [m.access(k) for k in range(m.n)] == all_ids and row["ends"][-1] == m.n


def test_wavelet_matrix():
    rnd = np.random.RandomState(1)
    for n, top in ((0, 5), (1, 1), (513, 2), (4000, 300)):
        ids = rnd.randint(0, top, n).astype(np.uint16)
        m = wavelet.WaveletMatrix.build(ids, 9)
        assert (m.all() == ids).all() and [m.access(k) for k in range(0, n, 53)] == ids[::53].tolist()
        for value in range(0, top, 17):
            places = np.flatnonzero(ids == value).tolist()
            assert m.count(value) == len(places) and [m.occurrence(value, k) for k in range(len(places))] == places and m.occurrence(value, len(places)) == -1
            assert m.count(value, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)


def _base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    runs = {}
    for i in range(len(w) - 7):
        runs.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + k for places in runs.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, rows):
    got = quality.quality_rules(docs).collect()
    want = [(i, *_base(t)) for i, t, *_ in rows]
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(want)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept) for r in got)


LEVELS = {"symbols": (0.9, None), "word_length": (0.9, 0.1), "dup_lines": (0.98, None), "repeats": (0.98, None)}


def _blended(values, q):
    """Brute force: quantile q by (lang, source), read from sorted lists of buckets, blended with the language's and the corpus's."""

    def read(numbers):
        buckets = sorted(0 if x <= 0 else 1 + math.floor(math.log(x) / math.log(1.02)) for x in numbers)
        bucket = next(b for k, b in enumerate(buckets, 1) if k >= len(buckets) * q)
        return 1.02**bucket if bucket else 0.0

    out, more = {}, 10 / (1 - max(q, 1 - q))
    for (lang, source), own in values.items():
        language = [x for (a, _), v in values.items() if a == lang for x in v]
        best = read([x for v in values.values() for x in v])
        for level in (language, own):
            best = (len(level) * read(level) + more * best) / (len(level) + more)
        out[lang, source] = best
    return out


def _bounds(features, groups):
    """{ratio: {group: (low, high)}}. features: {id: {ratio or length: number}}, groups: {group: ids}."""
    of = lambda name, q: _blended({g: [features[i][name] for i in ids] for g, ids in groups.items()}, q)
    n_words, n_lines, out = of("n_words", 0.5), of("n_lines", 0.5), {}
    step = {"symbols": lambda g: 1000 / n_words[g], "word_length": lambda g: 1000 / n_words[g], "dup_lines": lambda g: 1000 / n_lines[g], "repeats": lambda g: 16_000 / n_words[g]}
    for name, (top, low) in LEVELS.items():
        mid, high, bottom = of(name, 0.5), of(name, top), low and of(name, low)
        wide = lambda q: 6 / NormalDist().inv_cdf(max(q, 1 - q))
        out[name] = {g: (mid[g] - max(wide(low) * (mid[g] - bottom[g]), step[name](g)) if low else -1, mid[g] + max(wide(top) * (high[g] - mid[g]), step[name](g))) for g in groups}
    return out


def _features(t):
    n, chars, symbols, dup, repeated = _base(t)
    n_lines = len([x for x in t.split("\n") if x.strip()])
    if n < 20 or 100 * repeated > 30 * n:
        return None
    return {"symbols": 1000 * symbols // n, "word_length": 1000 * chars // n, "dup_lines": 1000 * dup // n_lines, "repeats": 1000 * repeated // n, "n_words": n, "n_lines": n_lines}


def _kept(rows):
    features = {i: f for i, t, *_ in rows if (f := _features(t or ""))}
    groups = {}
    for i, _, lang, source in rows:
        if i in features:
            groups.setdefault((lang, source), []).append(i)
    bounds = _bounds(features, groups)
    return {i for g, ids in groups.items() for i in ids if all(bounds[name][g][0] <= features[i][name] <= bounds[name][g][1] for name in LEVELS)}, features


def test_quality_verdicts(spark):
    rnd, rows = random.Random(19), []
    for k in range(500):
        lang, source = rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None])
        text = [" ".join(w + "#" * (rnd.random() < {"a": 0.3, "b": 0.05}.get(source, 0.0)) * rnd.randint(1, 4) for w in words(rnd, rnd.randint(4, 12))) for _ in range(rnd.randint(3, 12))]
        text += [text[0]] * rnd.choice([0] * 40 + [1, 2, 9]) + ["x" * rnd.randint(100, 900)] * (rnd.random() < 0.03)
        rows.append((k, "\n".join(text), lang, source))
    kept, features = _kept(rows)
    got = quality.quality_rules(frame(spark, rows)).collect()
    assert {r.doc_id for r in got if r.kept} == kept and 0 < len(kept) < len(features)


def test_habits_set_limits(spark):
    """Sources that repeat lines, runs and symbols as a habit have limits that let them, in every ratio; others don't."""
    rnd, rows = random.Random(23), []
    for k in range(1600):
        source = ("plain", "verse", "code", "long")[k % 4]
        lines = [" ".join(w + ("longer" if source == "long" and rnd.random() < 0.5 else "") + ("#" if source == "code" and rnd.random() < 0.3 else "") for w in words(rnd, 9)) for _ in range(rnd.randint(8, 14))]
        if source == "verse":
            lines += [rnd.choice(lines) for _ in range(rnd.randint(0, 2))]
        rows.append((k, "\n".join(lines), "en", source))
    docs = frame(spark, rows)
    kept = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    want, passed = _kept(rows)
    assert kept == want and len(kept) > 0.99 * len(passed) and len(passed) > 1500
    bounds = {r.limit_source: r for r in quality.limits(quality._features(docs, "doc_id", "text", "lang", "source").filter(~quality.base_failed())).collect()}
    assert bounds["verse"].high_dup_lines > 1.2 * bounds["plain"].high_dup_lines and bounds["verse"].high_repeats > 1.2 * bounds["plain"].high_repeats
    assert bounds["code"].high_symbols > 1.5 * bounds["plain"].high_symbols and bounds["long"].high_word_length > 1.1 * bounds["plain"].high_word_length


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_groups_have_limits_of_their_own(spark):
    docs = common.documents(spark, "/root/testdata/sf0.01")
    found = quality.limits(quality._features(docs, "doc_id", "text", "lang", "source").filter(~quality.base_failed())).collect()
    for name in LEVELS:
        assert len({r[f"high_{name}"] for r in found}) > len(found) / 2
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept} == _kept(rows)[0]


@pytest.mark.parametrize("most", [0, 250_000])
def test_quality_limits_follow_the_source(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_SENT", most)
    rnd = random.Random(9)
    clean = [(k, " ".join(words(rnd, 60)), "en", "a") for k in range(400)]
    marked = [(1000 + k, "# " + " ".join(words(rnd, 30)) + " & " + " ".join(words(rnd, 30)), "en", "code") for k in range(400)]
    junk = [(2000 + k, " ".join(x + "###" for x in words(rnd, 60)), "en", "a") for k in range(40)]
    docs = frame(spark, clean + marked + junk + clean[:3])
    kept = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    assert kept == {i for i, *_ in clean + marked}
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted([*kept, *(i for i, *_ in clean[:3])])


@pytest.mark.parametrize("size", [60, 150, 199, 201])
def test_small_sources_have_limits_of_their_own(spark, size):
    rnd = random.Random(13)
    clean = [(k, " ".join(words(rnd, 60)), "en", "a") for k in range(300)]
    code = [(1000 + k, " ".join(x + ("#" if j % 4 == 0 else "") for j, x in enumerate(words(rnd, 60))), "en", "code") for k in range(size)]
    junk = [(2000 + k, " ".join(x + "###" for x in words(rnd, 60)), "en", s) for k, s in enumerate(("a", "code"))]
    kept = {r.doc_id for r in quality.quality_rules(frame(spark, clean + code + junk)).collect() if r.kept}
    assert kept == {i for i, *_ in clean + code}


def test_every_ratio_rejects_an_outlier(spark):
    rnd = random.Random(14)

    def text(n_lines=12):
        return [" ".join(words(rnd, 8)) for _ in range(n_lines)]

    clean = [(k, "\n".join(text()), "en", "a") for k in range(300)]
    twice = text(10)
    run, short = " ".join(words(rnd, 10)), " ".join(words(rnd, 3))
    outliers = {
        "symbols": " ".join(x[:-2] + "##" for x in "\n".join(text()).split()), "word_length": "\n".join(text()).replace(" ", "longer "),
        "dup_lines": "\n".join(x for line in text(8) for x in (line, short)), "repeats": "\n".join([*twice, run, *text(1), run]),
    }
    docs = frame(spark, clean + [(1000 + k, t, "en", "a") for k, t in enumerate(outliers.values())])
    got = quality.quality_rules(docs).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} == {i for i, *_ in clean}
    bounds = quality.limits(quality._features(docs, "doc_id", "text", "lang", "source").filter(~quality.base_failed())).first()
    for name, r in zip(outliers, sorted((r for r in got if r.doc_id >= 1000), key=lambda r: r.doc_id)):
        ratios = [1000 * r.n_symbols // r.n_words, 1000 * r.word_chars // r.n_words, 1000 * r.n_dup_lines // r.n_lines, 1000 * r.n_repeat_words // r.n_words]
        assert [x for x, value in zip(quality.RATIOS, ratios) if not bounds[f"low_{x}"] <= value <= bounds[f"high_{x}"]] == [name]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="ad">Buy now</div><{tag}><h1>Head &amp; line</h1><p>First   <b>para</b>\n with <a href="x>y">link</a>.<p>Second &#233;&nbsp;one<br>more<ul><li>point</ul></{end}>
<section id="comments"><p>A reader wrote a lot, more than the article has in all, and more, and still more than that, to be sure of it.</p></section><footer>&copy; foot</footer>"""
TEXT = "Head & line\nFirst para with link.\nSecond é one more\npoint"


def test_html_text(spark):
    pages = [(k, "https://www.Host.example/a", PAGE.format(tag="article", end="article")) for k in range(5)] + [
        (5, "https://host.example:80/b", PAGE.format(tag='div class="post-12 body"', end="div")),
        (6, None, None), (7, "nonsense", ""), (8, "https://host.example/c", "<p>" + "long text " * 30_000), (0, "https://www.Host.example/a", PAGE.format(tag="article", end="article")),
    ]
    df = spark.createDataFrame([(*p, "clash", "clash", 3) for p in pages], "page_id long, url string, html string, text string, host string, n_chars long")
    got = html_text.extract_text(df).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r for r in got}
    assert all(by_id[k].text == TEXT for k in range(6)) and by_id[6].text == by_id[7].text == "" and by_id[8].n_chars == 300_000 - 1
    assert by_id[0].host == by_id[5].host == "host.example" and by_id[0].path == "body>article"


def test_host_consensus_overrules_a_page(spark):
    usual = '<body><div class="story"><p>{}</p></div><div class="aftermath"><p>{}</p></div></body>'
    pages = [(k, "http://h/a", usual.format("main text " * 20, "extra " * 5)) for k in range(9)] + [(9, "http://h/b", usual.format("short main", "extra words " * 60))]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[9] == "short main"


def _made_page(rnd, host):
    """A page of one of several designs, and its article's blocks, known from how it is made."""
    design = host % 6
    say = lambda n: " ".join(rnd.choice("river stone light cloud ember quiet marsh north vale harbour lantern".split()) for _ in range(n))
    blocks, body = [], []

    def block(open_tag, text, html=None, close=True):
        blocks.append(text)
        body.append(f"<{open_tag}>{html or text}" + (f"</{open_tag.split()[0]}>" if close else ""))

    block("h1", f"{say(3)} & {say(2)}", None)
    body[-1] = body[-1].replace("&", rnd.choice(["&amp;", "&#38;", "&"]))
    for _ in range(rnd.randint(3, 7)):
        kind = rnd.randrange(7)
        words = [say(rnd.randint(14, 30)) + ".", say(rnd.randint(3, 6))]
        if kind == 0:
            block("h2 class=sub", words[1])
        elif kind == 1:
            for k in range(3):
                block("li", f"{words[1]} {k}", close=False)
            body[-3] = "<ul>" + body[-3]
            body[-1] += "</ul>"
        elif kind == 2:
            block("blockquote", words[0])
        elif kind == 3:
            block('p class="legal"' if design != 3 else "p", words[0], words[0].replace(" ", " \n\t<i>", 1).replace(".", "</i>."))
        elif kind == 4:
            block("p", words[0], words[0][:-1] + f"<!-- <p>{say(3)}</p> --><script>var x = '<p>{say(4)}</p>';</script>.", close=False)
        elif kind == 5:
            block("p title='a > b'", f"{words[0]} {words[1]}", f'{words[0]} <a href="/x?a=1&b=2">{words[1]}</a><select><option>{say(2)}<option>{say(2)}</select>')
        else:
            block("p", f"{words[0]} é", f"{words[0]}&nbsp;<br>&eacute;")
    nav = "<nav><ul>" + "".join(f"<li><a href=/{k}>{say(1)}</a>" for k in range(5)) + "</ul></nav>"
    links = '<div class="links">' + " ".join(f"<a href=/{k}>{say(2)}</a>" for k in range(6)) + "</div>"
    advert, notice = f'<div class="ad-{rnd.randint(1, 9)} box">{say(rnd.randint(3, 9))}</div>', f'<div id="cookie-notice"><p>{say(12)}.</p></div>'
    comments = '<section class="comments">' + "".join(f'<div class="comment"><b>{say(1)}</b><p>{say(rnd.randint(5, 25))}.</p></div>' for _ in range(rnd.randint(2, 4))) + "</section>"
    form, foot = f"<form action=/s><p>{say(4)}</p><textarea>{say(5)}</textarea></form>", f"<footer><p>&copy; {say(12)}.</p></footer>"
    inside = list(body)
    if design in (1, 4):
        inside.insert(rnd.randint(1, len(inside)), advert)
    whole = {
        0: lambda: f"{nav}<article>{''.join(inside)}</article>{advert}{comments}{foot}",
        1: lambda: f"<header>{say(4)}</header>{nav}<main><div class='post'>{''.join(inside)}</div></main><aside><p>{say(30)}.</p></aside>{foot}",
        2: lambda: f"{links}<div id=wrap class='has-sidebar'><div class=entry>{''.join(inside)}</div>{form}</div>{notice}{foot}",
        3: lambda: f"{nav}<div class=a>{inside[0]}{inside[1]}</div><div class=b>{''.join(inside[2:])}</div>{comments}{foot}",
        4: lambda: f"{nav}<div class=page><article class=story>{''.join(inside)}{comments}</article>{links}</div>{notice}",
        5: lambda: f"{nav}{advert}<table><tr><td>{''.join(inside)}</table>{form}{foot}",
    }[design]()
    return f"<!DOCTYPE html><html><head><title>{say(3)}</title><style>p > b {{}}</style></head><body>{whole}</body></html>", "\n".join(blocks)


def test_html_text_of_made_pages(spark):
    rnd = random.Random(31)
    made = [(k, f"https://h{k % 12}.example/{k}", *_made_page(rnd, k % 12)) for k in range(240)]
    pages = spark.createDataFrame([x[:3] for x in made], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(pages.repartition(7)).collect()}
    wrong = [(k, got[k], text) for k, _, _, text in made if got[k] != text]
    assert not wrong, (len(wrong), wrong[0])


def test_a_name_alone_drops_nothing(spark):
    """What no other evidence speaks against stays, whatever it is called; a text that all pages of a host have goes."""
    prose = "The legal side of this matter is a part of the article, as whole sentences say in the page {}."
    page = '<body><article><h1>Title</h1><p>The first paragraph of the article has enough words to read as prose here.</p><p class="legal">' + prose + '</p><div class="social"><p>' + prose + "</p></div>{}</article></body>"
    links = '<div class="social"><a href=/a>Tell</a> <a href=/b>others</a></div>'
    pages = [(k, "http://one/" + str(k), page.format(k, k, links)) for k in range(5)] + [(k, "http://two/" + str(k), page.format("x", "x", links)) for k in range(5, 10)]
    got = {r.page_id: r.text.split("\n") for r in html_text.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k][2:] == [prose.format(k)] * 2 for k in range(5)) and all(len(got[k]) == 2 for k in range(5, 10))


@pytest.mark.parametrize("element", ["object", "canvas", "noscript", "select", "svg", "datalist", "textarea", "iframe"])
def test_elements_that_are_never_closed_end_with_their_parent(element):
    page = f"<body><article><p>Before it there is some text in the article.</p><div><{element}>x</div><p>After it the article goes on with some words.</p></article></body>"
    assert html_text.Page(page).text(None)[0] == "Before it there is some text in the article.\nAfter it the article goes on with some words."


def test_tags_of_any_length():
    page = html_text.Page(f"<p data-x='{'>' * 20_000}' title=it's>one</p><p a=\"never closed>two</p>")
    assert page.text(None)[0] == "one\ntwo"


@pytest.mark.parametrize("html", ["", "<", "<p", "<!-- open", "<script>never closed", "</p></p>", "<a href='", "plain", "<" * 300, "<div>" * 3000, "&#x110000; &bogus; &amp"])
def test_broken_html(html):
    page = html_text.Page(html)
    assert isinstance(page.text(None)[0], str) and isinstance(page.votes(), dict)


def test_empty_tables(spark):
    empty = frame(spark, []).limit(0)
    for run in (exact_dedup.exact_dedup, line_dedup.line_report, substring_dedup.removed_spans, near_dedup.near_duplicates, sharding.shard_law, mixing.taken_words, quality.quality_rules):
        assert run(empty).collect() == []
    assert bpe.encode_and_decode(empty, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect() == []
    assert wavelet.round_trip(empty, public_tokenizers.path("byte_bpe_50k.json")).collect() == []
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_null_ids(spark):
    rows = [(None, "same text of five words and more", "en", "a"), (None, "same text of five words and more", None, None), (3, "same text of five words and more", "en", "a"), (None, None, None, None)]
    docs = frame(spark, rows)
    exact = exact_dedup.exact_dedup(docs).collect()
    assert sorted((r.keep_id is None, r.group_size) for r in exact) == [(False, 3), (False, 3), (False, 3), (True, 1)]
    near = near_dedup.near_duplicates(docs).collect()
    assert sorted(str(r.component_id) for r in near) == ["3", "3", "3", "None"]
    for run in (line_dedup.line_report, sharding.shard_law, mixing.taken_words, quality.quality_rules):
        assert run(docs).count() >= 4
    assert substring_dedup.removed_spans(docs).count() == 1


def test_offsets_stay_with_their_text(spark):
    line, other = "one line of quite a few words here", "another line of several more words here"
    rows = [(1, f"{line}\n{other}\nlast words of it", "en", "a"), (None, f"{line}\nsome", "en", "a"), (None, f"some\nthing\nelse\n{other}", "en", "a"), (7, other, "en", "a"), (7, f"x\n{line}", "en", "a")]
    left = [r.text for r in substring_dedup.without_repeats(frame(spark, rows)).collect()]
    assert sorted(left) == sorted([rows[0][1], "\nsome", "some\nthing\nelse\n", "", "x\n"])
    rows = [(1, "a b\nc d\ne f\ng h", "en", "a"), (None, "a b\nc d\ne f\nz", "en", "a"), (None, "y\nc d\ne f\ng h", "en", "a")]
    left = [r.text for r in line_dedup.without_repeated_lines(frame(spark, rows)).collect()]
    assert sorted(left) == sorted([rows[0][1], "z", "y"])
