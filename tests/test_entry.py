"""The driver contract holds with and without the optional subpackage."""

import subprocess
import sys

import __spark_entry__ as entry

BLOCKED = """
import sys
sys.modules["textlab.llm"] = None
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
names = set(e.queries())
assert "token_stats" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(e.oracle_sql()) <= names
"""


def test_entry_without_the_subpackage():
    subprocess.run([sys.executable, "-c", BLOCKED], check=True, timeout=120)


def test_every_statement_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
