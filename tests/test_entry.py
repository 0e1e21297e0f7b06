"""The driver's contract, with and without the optional corpus part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def listed(code):
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    return [set(line.split()) for line in out.strip().splitlines()]


@pytest.mark.parametrize("hidden", ["xxhash", "quarry.llm", "corpus_pipeline", "zstandard"])
def test_base_queries_stay_when_something_of_the_corpus_part_is_missing(hidden):
    queries, sql = listed(f"import sys; sys.modules[{hidden!r}] = None; {LIST}")
    whole, whole_sql = listed(LIST)
    from quarry.plans.registry import registry
    assert queries == sql == set(registry()) <= whole and sql <= whole_sql
