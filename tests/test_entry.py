"""The driver's contract."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as E

ROOT = Path(E.__file__).parent


def test_entry_has_rows(spark):
    assert E.entry(spark).count() > 0


def test_sql_is_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_rest_works_without_the_llm_parts(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "r")})
