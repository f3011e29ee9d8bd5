"""The driver's contract holds without the training-data operators or a library of theirs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["tiktoken", "tokenizers", "corpus_pipeline", "tillstream.llm"])
def test_a_missing_module_leaves_the_other_queries(blocked):
    code = (f"import sys; sys.modules[{blocked!r}] = None\n"
            "import __spark_entry__ as e\n"
            "assert 'sales_by_interval' in e.queries() and len(e.queries()) > 70\n"
            "assert set(e.oracle_sql()) <= set(e.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
