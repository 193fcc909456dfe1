"""Lexical search, conversation repair and SimHash against plain Python: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import heapq
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from granary.llm import common, conversations, lexical, simhash
from tests import oracle
from tests.llm.test_operators import corpus, docs, frame, words  # noqa: F401

CONV = "conv_id long, turn long, role string, text string, cost long, audit string, seen boolean, kind int, hub long"


# ---- lexical search


def _ranked(rows, items, k):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    found = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    tf = [(i, Counter(found(t))) for i, t in rows]
    sizes = [c.total() for _, c in tf]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, c), size in zip(tf, sizes):
            m = 25 + 75 * size * n // total if total else 25
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in found(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, at + 1, i, -s) for at, (s, _, i) in enumerate(heapq.nsmallest(k, scored))]
    return sorted(out, key=repr)


def _searched(spark, rows, items, k=10):
    table = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical.search(frame(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3), table, k).collect()), key=repr)


@pytest.mark.parametrize("most", [1, 1024])
def test_search_equals_scoring_every_document(spark, monkeypatch, most):
    monkeypatch.setattr(lexical, "ITEMS", most)
    monkeypatch.setattr(lexical, "BLOCK", 16)
    rnd = random.Random(5)
    rows = [(i, t) for i, t, *_ in corpus(5)] + [(None, "river1 stone2"), (None, "river1 stone2"), (900, "Ünïcode, ünïcode ÜNÏCODE\x7fx42"), (901, "-- ... ??")]
    items = [(1, " ".join(words(rnd, 30))), (2, "THE river1, the river1; light3"), (3, None), (4, ""), (5, "nothing-such"), (2, "ünïcode X42"), (None, rows[8][1])]
    assert _searched(spark, rows, items) == _ranked(rows, items, 10)


def test_search_ties_and_empty_tables(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(99, "other")]
    assert [r[2] for r in sorted(_searched(spark, rows, [(7, "words")], 3))] == [1, 2, 3]
    assert _searched(spark, [(1, None)], [(7, "words")]) == _searched(spark, [], [(7, "words")]) == _searched(spark, rows, []) == []


def test_slices_add_up_and_the_highest_come_off_the_top():
    rnd = random.Random(1)
    for _ in range(60):
        n = rnd.choice([1, 7, 64, 300])
        sums, total = [0] * n, []
        for _ in range(rnd.randint(1, 9)):
            places = np.array(sorted(rnd.sample(range(n), rnd.randint(1, n))))
            values = np.array([rnd.choice([0, 1, 5, rnd.getrandbits(rnd.randint(1, 40))]) for _ in places], np.int64)
            lexical.add(total, lexical.bit_slices(places, values))
            for p, v in zip(places.tolist(), values.tolist()):
                sums[p] += v
        assert [sum((bits >> p & 1) << k for k, bits in enumerate(total)) for p in range(n)] == sums
        k = rnd.randint(1, 12)
        assert sorted((-v, p) for p, v in lexical.highest(total, k)) == sorted((-v, p) for p, v in enumerate(sums) if v)[:k]


# ---- conversation repair


def _best(rows):
    """Least (cost, audit) with the repaired rows, by trying edits in the order of their costs. rows: role, text, fault."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, at, state, kept = heapq.heappop(queue)
        if at == len(rows) and state in (0, 3):
            return cost, audit, kept
        if (at, state) in done:
            continue
        done.add((at, state))
        turn = "assistant" if state == 2 else "user"
        after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(queue, (cost + 5, audit + "I", at, after, (*kept, (turn, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state, kept))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, after, (*kept, (turn, text))))
                if role[:1] == turn[0] or state == 0 and role[:1] == "s":
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, 1 if role[:1] == "s" else after, (*kept, (role, text))))


def _reported(rows, damage=True):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = role if role is not None else " ", text if text is not None else " "
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        judged = []
        for at, (_, role, text) in enumerate(mine):
            stripped = text.strip(" \t\n\x0b\x0c\r")
            judged.append((role, text, "blank" if not stripped else "duplicate" if (role, text) in [r[1:] for r in mine[:at]] else "truncated" if stripped[-1] not in ".!?" else ""))
        turns = [r[0] for r in mine if r[0] is not None]
        faults = Counter(j[2] for j in judged)
        cost, audit, kept = _best(judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        whole = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest(), kept)
    return out


def _conversations(seed=3, n=120):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.randint(1, 9)):
            role = rnd.choice(["system", "user", "assistant"]) if rnd.random() < 0.3 or turn == 0 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * rnd.choice([1, 1, 2]), role, rnd.choice(["One. ", "Two!\n", "three", "Fünf? ", " \t", ""]) + rnd.choice(["", "", "Yes."])))
    rows += [(1000, None, None, None), (1000, None, "user", "Hi."), (1000, 3, "tool", "x."), (1000, 3, "", "y."), (None, 1, "user", "A."), (None, 1, "user", "A."), (None, None, "assistant", "B.")]
    rows += [(1001, 0, "user", "long. " * 50_000), *[(1002, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)], *[(1003, 5, "user", "Same.")] * 30]
    rows += [(c, 0, "user", "Gone.") for c in range(2000, 2200)]
    return rows


def _talks(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", True, 2, 3) for r in rows], CONV).repartition(5)


def test_repair_equals_a_search_for_the_cheapest_edits(spark):
    rows = _conversations()
    want = _reported(rows)
    got = {r.conv_id: tuple(r) for r in conversations.repair_damaged(_talks(spark, rows)).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}
    assert any(v[7] == "" and v[6] == 0 for v in want.values()) and {x for v in want.values() for x in v[7]} == set("DKR")


def test_repaired_rows_are_those_of_the_digest(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_SENT", 0)
    rows = [r for r in _conversations(4, 60) if r[0] != 1001]
    want = _reported(rows, damage=False)
    found = {k: [] for k in want}
    for r in sorted(conversations.repaired_rows(_talks(spark, rows)).collect(), key=lambda r: r.place):
        found[r.conv_id].append((r.role, r.text))
    assert found == {k: list(v[-1]) for k, v in want.items()}


def test_layers_of_shared_prefixes_are_worked_out_once(monkeypatch):
    made, plain = [], conversations.next_layer
    monkeypatch.setattr(conversations, "next_layer", lambda layer, letter: (made.append(letter), plain(layer, letter))[1])
    signatures = sorted("".join(x) for n in range(5) for x in itertools.product("suaAx", repeat=n))
    got = list(conversations.answers(signatures))
    assert len(made) == len(signatures) - 1  # one for each node of the trie but its root
    fault = lambda c: "blank" if c == "x" else "truncated" if c.isupper() else ""
    assert got == [(s, *_best([(c.lower(), c, fault(c)) for c in s])[:2]) for s in signatures]


def test_no_conversations(spark):
    assert conversations.repair_damaged(_talks(spark, [])).count() == 0 and conversations.repaired_rows(_talks(spark, [])).count() == 0


# ---- SimHash


def _print(text):
    found = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", found) if w]
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, c in ones.items() if 2 * c > len(shingles))


def _components(rows):
    prints = [_print(t) for _, t in rows]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 3:
            root[find(a)] = find(b)
    ids = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            ids[find(p)] = min(i, ids.get(find(p), i))
    return sorted(((i, f"{p:016x}", ids.get(find(p))) for (i, _), p in zip(rows, prints)), key=repr)


@pytest.mark.parametrize(("crowded", "most"), [(256, 250_000), (2, 250_000), (2, 0)])
def test_simhash_equals_comparing_all_pairs(spark, monkeypatch, crowded, most):
    monkeypatch.setattr(common, "MOST_SENT", most)
    rnd = random.Random(8)
    base = words(rnd, 300)
    rows = [(i, t) for i, t, *_ in corpus(9)] + [(None, "no id at all"), (None, None), (5, "an id twice"), (5000, "Ab\tCD  ef"), (5001, "aB cd Ef")]
    rows += [(300 + k, " ".join("new" if j in rnd.sample(range(300), k % 4) else w for j, w in enumerate(base))) for k in range(60)]
    got = simhash.simhash_duplicates(frame(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3), crowded=crowded).collect()
    want = _components(rows)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    assert len({c for *_, c in want}) < len({f for _, f, _ in want})  # some links are not between copies


def test_fingerprints_three_bits_apart_share_a_key():
    rnd = np.random.default_rng(4)
    for _ in range(40):
        a = rnd.integers(0, 2**64, 500, np.uint64)
        b = a.copy()
        for _ in range(3):
            b ^= np.uint64(1) << rnd.integers(0, 64, 500, np.uint64)
        (n, x), (m, y) = simhash.bucket_keys(a), simhash.bucket_keys(b)
        x, y = np.split(x, np.cumsum(n)[:-1]), np.split(y, np.cumsum(m)[:-1])
        assert all(np.intersect1d(p, q).size for p, q in zip(x, y)) and n.max() <= 42


def test_golay_words_have_a_codeword_within_three_bits():
    every = np.arange(1 << 12, dtype=np.int64) << 11 | 0x155
    rest, error = simhash._corrections()
    assert len(np.unique(error)) == 2048 and all(x.bit_count() <= 3 for x in error.tolist())
    assert len(np.unique(simhash.index(every))) > 1 and (simhash.index(np.array([0, 1, 7, 1 << 22])) == 0).all()


def test_a_forest_joins_what_links_join():
    rnd = random.Random(6)
    for _ in range(50):
        some = {rnd.getrandbits(64) for _ in range(4)}
        some |= {x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for x in list(some) * 8}
        members = sorted(some)
        edges = simhash.forest(np.array(members, np.uint64))
        assert all((a ^ b).bit_count() <= 3 for a, b in edges)
        group = {m: {m} for m in members}
        for pairs in (edges,):
            for a, b in pairs:
                if group[a] is not group[b]:
                    group[a] |= group[b]
                    for m in group[b]:
                        group[m] = group[a]
        for a, b in itertools.combinations(members, 2):
            assert (a ^ b).bit_count() > 3 or group[a] is group[b]


def test_no_documents(spark):
    assert simhash.simhash_duplicates(frame(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(oracle.SF_DIR), reason="no test tables")
def test_simhash_query(spark):
    from granary.llm import registry

    got = registry.queries()["op13_simhash_near_dedup"](spark, oracle.SF_DIR).collect()
    rows = [(r.doc_id, r.text) for r in common.documents(spark, oracle.SF_DIR).collect()]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == _components(rows)


def test_the_repair_oracle_equals_plain_python(spark):
    """The SQL over the same rows, repeated rows and nulls among them."""
    import duckdb
    import pyarrow as pa

    rows = [r for r in _conversations(7, 90) if r[0] not in (1001, 1002)]
    conversations_table = pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate((("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())))})
    con = duckdb.connect()
    con.register("conversations", conversations_table)
    found = con.execute(conversations.ORACLE)
    names = [d[0] for d in found.description]
    got = {r[names.index("conv_id")]: tuple(r[names.index(c)] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in found.fetchall()}
    assert got == {k: v[:-1] for k, v in _reported(rows).items()}
