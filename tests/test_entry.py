"""The optional subpackage: without it everything else imports and is registered."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(%r):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from profitlens.catalog import QUERIES
assert set(e.queries()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
e.oracle_sql()
"""


def test_queries_without_the_subpackage():
    for name in ("profitlens.llm", "corpus_pipeline"):
        subprocess.run([sys.executable, "-c", BLOCK % name], cwd=ROOT, check=True)
