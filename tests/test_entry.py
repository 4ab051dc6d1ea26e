"""The entry point without the optional operators, or without a library of theirs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from tierflow.workload.queries import QUERIES

ROOT = Path(__file__).parent.parent


def names(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries(), sep='\\n')"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    return done.stdout.split(), done.stderr


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tierflow.llm", "tierflow.llm.queries", "xxhash", "numpy"])
def test_core_queries_are_always_there(missing):
    found, said = names(missing)
    assert set(QUERIES) <= set(found)
    if set(found) == set(QUERIES):
        assert "are left out" in said
