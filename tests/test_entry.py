"""The entry points without the optional subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()) > 60)"


def run(folder: Path, before: str = "") -> str:
    done = subprocess.run(
        [sys.executable, "-c", f"{before}\n{COUNT}"], cwd=folder, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


@pytest.fixture
def copy(tmp_path):
    for name in ("curate", "__spark_entry__.py"):
        source = REPO / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    return tmp_path


def test_queries_load_without_the_subpackage(copy):
    shutil.rmtree(copy / "curate" / "llm", ignore_errors=True)
    assert run(copy) == "True True"


def test_queries_load_with_an_emptied_folder(copy):
    folder = copy / "curate" / "llm"
    shutil.rmtree(folder, ignore_errors=True)
    (folder / "__pycache__").mkdir(parents=True)
    assert run(copy) == "True True"


def test_queries_load_without_a_library_of_the_subpackage(copy):
    assert run(copy, "import sys; sys.modules['xxhash'] = None") == "True True"
