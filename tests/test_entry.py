"""The registry stands without the corpus subpackage."""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_without_the_corpus_subpackage(tmp_path):
    shutil.copytree(ROOT / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(q) == set(e.oracle_sql()))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) > 60 and out[1] == "True"


def test_nothing_else_imports_it():
    for p in (ROOT / "tickloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", p.read_text(), re.M), p


def test_the_other_tests_need_neither_folder(tmp_path):
    """Everything is collected, and a part of the tests run, where the corpus subpackage, its tests and its pipeline are gone."""
    for name in ("tickloom", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    run = lambda *a: subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", *a], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    found = run("--collect-only", "tests")
    assert found.returncode == 0, found.stdout[-2000:]
    ran = run("tests/test_operators.py", "-k", "seed or msgpack or entry")
    assert ran.returncode == 0, ran.stdout[-2000:]
