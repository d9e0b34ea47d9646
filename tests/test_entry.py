"""The registered queries without the text operators."""

import subprocess
import sys

import pytest

import __spark_entry__ as contract

REPO = contract.__file__.rsplit("/", 1)[0]


@pytest.mark.parametrize("absent", ["corpus_pipeline", "isochron.llm", "public_tokenizers", "xxhash"])
def test_other_queries_stay_where_the_text_operators_cannot_be_imported(absent):
    program = f"""
import sys
sys.modules[{absent!r}] = None
sys.path.insert(0, {REPO!r})
import __spark_entry__ as contract
names = contract.queries().keys()
assert not any(n.startswith("op") or n == "pipeline" for n in names) and len(names) > 100
assert names == contract.oracle_sql().keys()
"""
    subprocess.run([sys.executable, "-c", program], check=True, timeout=120)
