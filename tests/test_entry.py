"""The driver contract, with and without the training-data operators."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "cadenza.llm"):
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
print(len(entry.queries()), set(entry.oracle_sql()) <= set(entry.queries()))
"""


def test_entry_works_without_the_llm_package():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr
    n, known = done.stdout.split()
    assert int(n) == 41 and known == "True"


def test_every_own_query_has_its_sql():
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    assert set(ORACLES) == set(QUERIES)


def test_nothing_in_the_library_imports_the_llm_package():
    for folder in ("cadenza", "workload"):
        for path, _, names in os.walk(os.path.join(ROOT, folder)):
            if os.path.join("cadenza", "llm") in path:
                continue
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(path, name), encoding="utf-8") as file:
                        assert "cadenza.llm" not in file.read(), name
