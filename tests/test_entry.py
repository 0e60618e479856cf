"""The registry stands without the optional subpackage and the packages it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
HIDE = "import sys; sys.modules[{name!r}] = None; import warnings; warnings.simplefilter('ignore'); "
ASK = ("import __spark_entry__ as e; from daybrook.catalog import all_queries, all_oracles; "
       "assert set(e.queries()) >= set(all_queries()) and set(e.oracle_sql()) >= set(all_oracles()); print(len(e.queries()))")


@pytest.mark.parametrize("name", ["xxhash", "tokenizers", "daybrook.llm", "daybrook.llm.queries", "corpus_pipeline"])
def test_core_queries_are_there_without(name):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name) + ASK], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) >= 100
