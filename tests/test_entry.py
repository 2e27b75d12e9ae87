"""The entry file in a copy of the repository without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("gone", [("tessera/llm",), ("tessera/llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_operators(tmp_path, gone):
    copy = tmp_path / "repo"
    skip = {os.path.join(ROOT, g) for g in gone} | {os.path.join(ROOT, "tests"), os.path.join(ROOT, ".git")}
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if os.path.join(d, n) in skip or n == "__pycache__"])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    count, extra, known = out.stdout.split()
    assert int(count) > 60 and extra == "False" and known == "True"
