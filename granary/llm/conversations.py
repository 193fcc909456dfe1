"""Conversation structure repair by dynamic programming over a trie of signatures.

A conversation's signature has a letter for each row: its role's initial and its fault. What repairing costs depends on the
signature alone, so conversations are grouped by it first. Distinct signatures are dealt by ranges and sorted, which is
the order of a walk through their prefix trie: the layers of the path to the current node are kept, a layer is worked
out once for all signatures below it, and an answer is read off where a signature ends.
"""

from __future__ import annotations

import hashlib
import os.path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import SPACES, cut, cut_few, join_known, sent

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the first and the last may end. What a role's initial leads to.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state that a rerole or an insertion leads to, and the role it takes.
NEXT = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
ENDS = (0, 3)
#: The letter of rows that must go. Other rows have their role's initial (o for any but s, u and a), a capital if they are truncated.
GONE = "x"
FAR = 1 << 60


def row_edits(letter: str) -> list[list[tuple[str, int, int]]]:
    """For each state, the edits of a row with this letter: initial, cost and state after; by initial."""
    out = []
    for state in range(4):
        edits = [("D", DELETE, state)]
        if letter != GONE:
            more = TRUNCATED * letter.isupper()
            if letter.lower() in STEPS[state]:
                edits.append(("K", KEEP + more, STEPS[state][letter.lower()]))
            edits.append(("R", REROLE + more, NEXT[state][0]))
        out.append(edits)
    return out


EDITS = {letter: row_edits(letter) for letter in "suaoSUAO" + GONE}


def _closed(layer: list[int]) -> tuple[int, ...]:
    """The layer's least costs with insertions; two in a row are the most that help."""
    for _ in range(2):
        for state, (after, _role) in enumerate(NEXT):
            layer[after] = min(layer[after], layer[state] + INSERT)
    return tuple(layer)


FIRST = _closed([0, FAR, FAR, FAR])


def next_layer(layer: tuple[int, ...], letter: str) -> tuple[int, ...]:
    """The least cost of reaching each state after one row more."""
    out = [FAR] * 4
    for state, edits in enumerate(EDITS[letter]):
        for _, cost, after in edits:
            out[after] = min(out[after], layer[state] + cost)
    return _closed(out)


def read_answer(signature: str, layers: list[tuple[int, ...]]) -> tuple[int, str]:
    """Cost and audit: the least string among the cheapest. layers: one more than letters.

    Backwards, the states are marked from which a cheapest end is reached at the costs of the layers; forwards, the
    first initial that stays on marked states is taken at each step. An audit determines its states.
    """
    n = len(signature)
    goal = min(layers[n][state] for state in ENDS)
    marked = [[False] * 4 for _ in layers]
    for state in ENDS:
        marked[n][state] = layers[n][state] == goal
    for at in range(n, -1, -1):
        layer, mine = layers[at], marked[at]
        if at < n:
            for state, edits in enumerate(EDITS[signature[at]]):
                mine[state] = any(marked[at + 1][after] and layer[state] + cost == layers[at + 1][after] for _, cost, after in edits)
        for _ in range(2):
            for state, (after, _role) in enumerate(NEXT):
                mine[state] |= mine[after] and layer[state] + INSERT == layer[after]
    at, state, audit = 0, 0, []
    while at < n or not (state in ENDS and layers[n][state] == goal):
        ways = [("I", INSERT, NEXT[state][0], 0)]
        if at < n:
            ways += [(*edit, 1) for edit in EDITS[signature[at]][state]]
        initial, _, state, step = min(way for way in ways if marked[at + way[3]][way[2]] and layers[at][state] + way[1] == layers[at + way[3]][way[2]])
        audit.append(initial)
        at += step
    return goal, "".join(audit)


def answers(signatures):
    """signature, cost, audit for ascending signatures; layers of prefixes that neighbours share are worked out once."""
    path, before = [FIRST], ""
    for signature in signatures:
        shared = len(os.path.commonprefix([before, signature]))
        del path[shared + 1 :]
        for letter in signature[shared:]:
            path.append(next_layer(path[-1], letter))
        yield (signature, *read_answer(signature, path))
        before = signature


def _rows(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, role, text, blank, truncated and seen (role and text stood in an earlier turn)."""
    rows = convs.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    words = F.btrim("text", F.lit(SPACES))
    rows = rows.withColumns({"blank": words == "", "truncated": ~F.right(words, F.lit(1)).isin(".", "!", "?"), "digest": F.md5("text")})
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = rows.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).filter("first < last")
    rows = join_known(rows, sent(said.select("conv_id", "role", "digest", "first")), "conv_id", "role", "digest", how="left")
    return rows.withColumn("seen", F.coalesce(at > F.col("first"), F.lit(False))).drop("first", "digest")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations side by side, each in one task and in order, which Spark sorts on disk if it must."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "text")


def _signed(rows: DataFrame) -> DataFrame:
    """conv_id, signature and the counts of each conversation; of a conversation no more than the signature is held."""
    import pyarrow as pa

    names = ("gaps", "blank", "duplicate", "truncated", "illegal")
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]

    def run(batches):
        conv, letters, counts, low, turns, before = None, None, None, None, None, None

        def made(done):
            columns = list(zip(*done)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["conv_id", "signature", *names])

        def ended():
            gaps = 0 if low is None else before[0] - low + 1 - turns
            return (conv, "".join(letters), gaps, *counts)

        for batch in batches:
            done = []
            for of, turn, role, digest, blank, truncated, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if letters is None or of != conv:
                    if letters is not None:
                        done.append(ended())
                    conv, letters, counts, low, turns, before = of, [], [0, 0, 0, 0], None, 0, None
                now = (turn, role, digest)
                kind = 0 if blank else 1 if seen or now == before else 2 if truncated else None
                if kind is not None:
                    counts[kind] += 1
                counts[3] += before is not None and before[1][:1] + role[:1] not in ("su", "ua", "au")
                initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
                letters.append(GONE if kind in (0, 1) else initial.upper() if kind == 2 else initial)
                if turn is not None and (low is None or turn != before[0]):
                    low, turns = turn if low is None else low, turns + 1
                before = now
            if done:
                yield made(done)
        if letters is not None:
            yield made([ended()])

    picked = _in_order(rows).select("conv_id", "turn", "role", F.md5("text").alias("digest"), "blank", "truncated", "seen")
    return picked.mapInArrow(run, "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long")


def _answered(signed: DataFrame) -> DataFrame:
    """signature, cost, audit of every distinct signature."""
    import pyarrow as pa

    def run(batches):
        signatures = (s for batch in batches for s in batch.column(0).to_pylist())
        rows, size = [], 0
        for row in answers(signatures):
            rows.append(row)
            size += len(row[2])
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["signature", "cost", "audit"])
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["signature", "cost", "audit"])

    return signed.select("signature").distinct().repartitionByRange("signature").sortWithinPartitions("signature").mapInArrow(run, "signature string, cost long, audit string")


def _judged(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    signed = cut_few(_signed(rows))
    known = sent(_answered(signed).withColumnRenamed("signature", "of"))
    return cut_few(signed.join(known, F.col("signature") == F.col("of")).drop("signature", "of"))


def _edited(rows: DataFrame, judged: DataFrame, schema: str, begin, take, end) -> DataFrame:
    """Follows each conversation's audit through its rows; what begin, take and end do with it gives the rows of schema.

    Before its rows each conversation has a row with its audit. begin(conv_id) makes a state, take(state, edit, role, text)
    gets every edit's role and text and may give a row, end(state) may give one more.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    heads = judged.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    both = heads.union(rows.select("conv_id", F.lit(1), "turn", "role", "text", F.lit(None).cast("string")))
    into = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        state, audit, at, step = None, "", 0, 0

        def insertions():
            nonlocal at, step
            while audit[at : at + 1] == "I":
                step, role = NEXT[step]
                at += 1
                yield take(state, "I", role, "")

        for batch in batches:
            done = []
            for of, kind, _, role, text, given in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if state is not None:
                        done += [*insertions(), end(state)]
                    state, audit, at, step = begin(of), given, 0, 0
                    continue
                done += insertions()
                edit, at = audit[at], at + 1
                if edit == "K":
                    step = STEPS[step][role[:1]]
                elif edit == "R":
                    step, role = NEXT[step]
                done.append(take(state, edit, role, text))
            if done := [x for x in done if x is not None]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), into)], schema=into)
        if state is not None and (done := [x for x in [*insertions(), end(state)] if x is not None]):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), into)], schema=into)

    return _in_order(both, "kind").mapInArrow(run, schema)


def repaired_rows(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, place (from 0), role, text, edit (K, R or I) of the repaired conversations' rows.

    Rows go by turn, null first, then by role and text. Edits and faults are those of repair_report.
    """
    rows = cut(_rows(convs, conv_col, turn_col, role_col, text_col))

    def take(state, edit, role, text):
        if edit == "D":
            return None
        state[1] += 1
        return state[0], state[1] - 1, role, text, edit

    return _edited(rows, _judged(rows), "conv_id long, place long, role string, text string, edit string", lambda of: [of, 0], take, lambda state: None)


def repair_report(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, null first, then by role and text; a null role or text is one space. A row's first fault counts: blank, duplicate (role
    and text seen before in the conversation), truncated (the last character that is no white space isn't one of .!?). gaps are turns missing
    between the first and the last, illegal counts neighbours whose roles' initials aren't su, ua or au. The audit has the initials of
    the cheapest edits that leave initials (s?(ua)+)?, of equally cheap ones the least: Delete, Insert, Keep, Rerole. Rows with
    a null conv_id are one conversation. Repeated rows are duplicates; other columns are not read; an empty table gives no rows.

    A conversation's rows pass one task in order, as one SHA-256 runs over them, but stream through it: besides the current
    batch a task holds one signature or audit, a letter a row. Signatures shared by many conversations are answered once.
    """
    rows = cut(_rows(convs, conv_col, turn_col, role_col, text_col))
    judged = _judged(rows)

    def take(state, edit, role, text):
        if edit != "D":
            state[1].update(f"{chr(10) if state[2] else ''}{role}:{text}".encode())
            state[2] = True

    digests = _edited(rows, judged, "conv_id long, repaired_sha256 string", lambda of: [of, hashlib.sha256(), False], take, lambda state: (state[0], state[1].hexdigest()))
    return join_known(judged, digests, "conv_id")


def damaged(convs: DataFrame) -> DataFrame:
    """The rows of conversations (nulls as one space) damaged by crc32 of conv_id:turn modulo 20: 0 drops the row, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    role, text = F.when(kind == 4, F.lit("user")).otherwise(name("role")), F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(name("text"), ".!?", "")).otherwise(name("text"))
    rows = convs.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.withColumn("copy", F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))"))).drop("kind", "copy")


def repair_damaged(convs: DataFrame) -> DataFrame:
    """repair_report of the damaged rows for every conv_id there was; zeros and the empty string's hash where no row is left."""
    ids = convs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = join_known(ids, repair_report(damaged(convs)).withColumn("there", F.lit(True)), "conv_id", how="left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda c: unicode(c)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384::BIGINT) ELSE d // 2 END)),
    4294967295::BIGINT) % 20 AS kind FROM source),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
numbered AS (SELECT *, row_number() OVER () AS rid FROM damaged),
ordered AS (
  SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, rid) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, rid) AS nth FROM numbered),
faults AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial, CASE WHEN words = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM ordered),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
edits(q, letter, fits, after, price) AS (VALUES
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0), (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1),
  (2, 'R', NULL, 3, 1), (3, 'R', NULL, 2, 1), (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2)),
fills(q, after, price, letters) AS (VALUES
  (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (1, 2, 5, 'I'), (2, 3, 5, 'I'), (3, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, after AS q, price AS cost, letters AS audit FROM counts, fills WHERE q = 0
  UNION ALL
  SELECT conv_id, i, q, best.cost, best.audit FROM (
    SELECT d.conv_id, f.i, s.after AS q,
           min({'cost': d.cost + e.price + CASE WHEN f.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END + s.price, 'audit': d.audit || e.letter || s.letters}) AS best
    FROM dp d JOIN faults f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1 JOIN edits e ON e.q = d.q JOIN fills s ON s.q = e.after
    WHERE e.letter = 'D' OR f.fault NOT IN ('b', 'd') AND (e.letter = 'R' OR e.fits = f.initial)
    GROUP BY d.conv_id, f.i, s.after)),
solved AS (
  SELECT c.conv_id, min({'cost': d.cost, 'audit': d.audit}) AS best
  FROM counts c JOIN dp d ON d.conv_id IS NOT DISTINCT FROM c.conv_id AND d.i = c.n WHERE d.q IN (0, 3) GROUP BY c.conv_id),
letters AS (SELECT conv_id, unnest(range(1, len(best.audit) + 1)) AS p, unnest(string_split(best.audit, '')) AS letter FROM solved WHERE best.audit <> ''),
placed AS (
  SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS e FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
met AS (
  SELECT p.*, f.role, f.text, max(CASE WHEN p.e = 1 AND p.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS shift
  FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND p.letter <> 'I'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (e - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
  FROM met WHERE letter <> 'D' GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(s.best.cost, 0)::BIGINT AS cost, coalesce(s.best.audit, '') AS audit, sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
