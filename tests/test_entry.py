"""The entry with and without the language-model folder."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print('NAMES', *e.queries(), '|', *e.oracle_sql())"


def names(folder, **env):
    ran = subprocess.run(
        [sys.executable, "-B", "-c", NAMES], cwd=folder, env=os.environ | env, capture_output=True, text=True, timeout=300
    )
    assert ran.returncode == 0, ran.stderr
    found, sql = ran.stdout.rpartition("NAMES")[2].split("|")
    return set(found.split()), set(sql.split())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_the_language_model_folder(tmp_path, pipeline):
    gone = {"llm", ".git", "__pycache__"} | (set() if pipeline else {"corpus_pipeline.py"})
    shutil.copytree(REPO, tmp_path / "repo", ignore=lambda d, files: gone & set(files))
    found, sql = names(tmp_path / "repo")
    assert len(found) >= 66 and not any(n.startswith("op") or n == "pipeline" for n in found)
    assert sql and sql <= found


def test_entry_survives_a_library_that_only_the_operators_need(tmp_path):
    if not (REPO / "metropulse" / "llm").is_dir():
        pytest.skip("nothing to lose")
    (tmp_path / "zstandard.py").write_text("raise ImportError('not here', name='zstandard')\n")
    found, _ = names(REPO, PYTHONPATH=str(tmp_path))
    assert len(found) >= 66 and "pipeline" not in found
