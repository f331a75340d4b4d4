"""The driver's entry module, with and without the optional subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; from tidewater.plans.queries import QUERIES; print(sorted(e.queries()) == sorted(QUERIES), set(e.oracle_sql()) <= set(e.queries()))"


def test_entry_without_the_optional_subpackage(tmp_path):
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests")
    shutil.copytree(REPO, tmp_path / "tree", ignore=skip)
    got = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path / "tree", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, check=True)
    assert got.stdout.split() == ["True", "True"]


def test_every_core_query_has_sql():
    import __spark_entry__ as entry
    from tidewater.plans.queries import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql())
