"""Token files of empty tables, and folders that hold none."""

import public_tokenizers
import pytest

from granary.llm import wavelet
from tests.llm.test_operators import frame


@pytest.mark.parametrize("written", [False, True])
def test_folders_without_documents(spark, tmp_path, written):
    path = str(tmp_path / "tokens")
    if written:
        wavelet.write_tokens(frame(spark, []), path, public_tokenizers.path("byte_bpe_50k.json"))
    else:
        (tmp_path / "tokens").mkdir()
    for found in (wavelet.read_tokens(spark, path), wavelet.shard_starts(spark, path), wavelet.token_index(spark, path), wavelet.id_counts(spark, path, [0, 7]), wavelet.occurrences(spark, path, 0)):
        assert found.collect() == []


def test_ids_that_no_document_has(spark, tmp_path):
    path = str(tmp_path / "tokens")
    wavelet.write_tokens(frame(spark, [(1, "", None, None), (2, None, None, None)]), path, public_tokenizers.path("byte_bpe_50k.json"))
    assert {(r.id, r.n) for r in wavelet.id_counts(spark, path, [0, 7]).collect()} == {(0, 2), (7, 0)}
    assert wavelet.occurrences(spark, path, 7).collect() == [] and [r.n_tokens for r in wavelet.token_index(spark, path).collect()] == [1, 1]
