"""The driver's functions with and without the optional text operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from cofi.plans.catalog import ORACLE_SQL, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_rating_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_text_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))]


def test_without_a_package_of_the_text_operators():
    """A package that only they need is missing: the rating queries stay."""
    code = ("import sys; sys.modules['tokenizers'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))]
