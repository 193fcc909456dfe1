import hashlib
import os

import pytest

import corpus_pipeline
from granary.llm import quality, registry
from tests import oracle
from tests.llm.test_operators import SCHEMA, _norm, _shingles, corpus, words

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_oracle(spark, name):
    oracle.assert_same(spark, oracle.connection(), registry.queries()[name], registry.oracle_sql()[name])


def test_a_query_for_each_operator():
    numbers = sorted(int(x[2:].split("_")[0]) for x in registry.queries())
    assert numbers == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    """Each stage's decisions against plain Python, and the stages one by one against run()."""
    import random

    rnd = random.Random(11)
    rows = corpus(2, 50) + [(500 + k, " ".join(words(rnd, 90)), "en", rnd.choice("abc")) for k in range(60)]
    rows += [(700 + k, " ".join(words(random.Random(k), 90)) + " \n", "en", "a") for k in (1, 1, 2)] + [(800, " ".join(x + "##&" for x in words(rnd, 90)), "en", "a")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, lang, s, None, False, 0, 0, 0, "", 0, 0) for i, t, lang, s in rows], SCHEMA).repartition(3).write.parquet(path)

    docs = spark.read.parquet(path)
    judged = {(r.doc_id, r.n_words): r.kept for r in quality.quality_rules(docs).collect()}
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        outs.append(docs.collect())
        assert k == 4 or docs.columns == SCHEMA.replace(",", "").split()[::2]
    good, exact, near, mixed, encoded = outs
    size = lambda t: len((t or "").split())
    assert sorted(r.doc_id for r in good) == sorted(i for i, t, *_ in rows if judged[i, size(t)])
    assert 800 not in {r.doc_id for r in good} and {500 + k for k in range(60)} <= {r.doc_id for r in good}
    assert len({_norm(r.text) for r in exact}) == len({_norm(r.text) for r in good}) == len({r.doc_id for r in exact})
    sets = {r.doc_id: _shingles(r.text) for r in exact}
    alike = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    kept = {r.doc_id for r in near}
    assert all(not (a < b and alike(sets[a], sets[b]) and a in kept and b in kept) for a in sets for b in sets)
    assert {i for i in sets if not any(alike(sets[i], sets[j]) for j in sets if j != i)} <= kept
    assert {r.doc_id for r in mixed} <= kept and sum(size(r.text) for r in mixed) <= sum(size(r.text) for r in near)
    want = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed)
    assert sorted((r.doc_id, r.decoded_sha256) for r in encoded) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, encoded))


