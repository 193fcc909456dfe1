import os

import pytest

from granary.plans import catalog
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF_DIR), reason="no test tables")
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connection()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, con, name):
    oracle.assert_same(spark, con, catalog.queries()[name], ORACLES[name])


def test_queries_without_oracle(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert {*catalog.queries()} == {*ORACLES}


def test_the_rest_works_without_llm(tmp_path):
    """The subpackage, its tests and the pipeline may be gone."""
    import shutil
    import subprocess
    import sys

    home, copy = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), tmp_path / "copy"
    shutil.copytree(home, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "llm", "corpus_pipeline.py"))
    code = "import __spark_entry__ as e; assert 'deck_ranked' in e.queries() and not any(x.startswith('op') or x == 'pipeline' for x in (*e.queries(), *e.oracle_sql())); import bench, granary.cli"
    assert subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}).returncode == 0
    (copy / "granary" / "llm").mkdir()
    (copy / "granary" / "llm" / "registry.py").write_text("import no_such_library")
    (copy / "corpus_pipeline.py").write_text("")
    broken = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True)
    assert broken.returncode and b"no_such_library" in broken.stderr
