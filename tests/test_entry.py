"""The driver contract with a part or a library missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["xxhash", "regex", "tidemark.llm", "corpus_pipeline"])
def test_queries_work_without_the_optional_part(blocked):
    code = (f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as E; q = E.queries(); "
            "assert 'composite_total' in q and set(E.oracle_sql()) <= set(q), sorted(q); print(len(q))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) >= 63
