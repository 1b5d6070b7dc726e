"""The entry module imports, with the core queries, whichever of the optional parts are there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from caremill.plans.catalogue import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_the_optional_parts(tmp_path, pipeline):
    for folder in ("caremill", "oracles"):
        shutil.copytree(f"{ROOT}/{folder}", tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), "True"]
