"""The registry without the training-data subpackage or what it needs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_CODE = """
import sys
sys.modules[{name!r}] = None               # importing it raises ImportError
import warnings
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as E
names = set(E.queries())
assert not any(n.startswith("op1_") or n == "pipeline" for n in names), names
assert {{"q_top_airports", "q_itinerary_best", "stream_running_topk"}} <= names
assert set(E.oracle_sql()) <= names
assert any({name!r}.split(".")[0] in str(w.message) for w in said)
"""


@pytest.mark.parametrize("name", ["tiktoken", "public_tokenizers", "aerolap.llm", "corpus_pipeline"])
def test_flight_queries_stay_without(name):
    subprocess.run([sys.executable, "-c", _CODE.format(name=name)], cwd=ROOT, check=True)
