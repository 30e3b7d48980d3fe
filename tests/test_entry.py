"""The entry point where the corpus subpackage or a library of its own is missing."""

import os
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1] or name.startswith(sys.argv[1] + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(q.startswith("op") and q[2].isdigit() for q in e.queries()))
"""


@pytest.mark.parametrize("name", ["tallyworks.llm", "corpus_pipeline", "public_tokenizers", "tiktoken", "regex"])
def test_other_queries_stay(name):
    done = subprocess.run([sys.executable, "-c", BLOCKED, name], cwd=TOP, capture_output=True, text=True, timeout=120)
    queries, statements, corpus = done.stdout.split()
    assert (int(queries), corpus) == (int(statements), "False") and int(queries) > 50
