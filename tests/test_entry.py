"""The entry module with and without its optional parts, each in a process of its own."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PRINT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(set(e.queries()) & {'pipeline', 'op1_benchmark_leaks'}))"


def loaded(folder: str) -> str:
    done = subprocess.run([sys.executable, "-c", PRINT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout


@pytest.mark.parametrize("left_out", [["trackstats/llm"], ["trackstats/llm", "corpus_pipeline.py"]])
def test_without_the_subpackage_for_training_data(tmp_path, left_out):
    from trackstats.plans.all_queries import ORACLES, QUERIES
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda at, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(at, n), ROOT) in left_out])
    assert loaded(str(copy)).split() == [str(len(QUERIES)), str(len(ORACLES)), "[]"]
