import subprocess
import sys

import __spark_entry__ as entry
from tessera.llm.queries import QUERIES


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    code = "import sys, tessera.plans.registry, tessera.plans.oracle, bench; print([m for m in sys.modules if 'llm' in m])"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert out.stdout.strip().endswith("[]")
