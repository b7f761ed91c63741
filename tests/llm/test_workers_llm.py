"""The operators' queries, with workers that can't import the package."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from test_workers import run_elsewhere  # noqa: E402


def test_operators_with_workers_that_lack_the_package(tmp_path):
    run_elsewhere(tmp_path, "from corpusmill.llm.queries import QUERIES", 2)
