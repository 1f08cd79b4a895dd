"""The driver contract with and without the llm subpackage."""

import subprocess
import sys

from conftest import ROOT

WITHOUT = """
import sys
sys.path.insert(0, %r)
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in %r:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as E
from hazardlens.plans import registry
assert set(E.queries()) == set(registry.queries()), set(E.queries()) ^ set(registry.queries())
assert set(E.oracle_sql()) == set(registry.oracle_sql())
print("ok")
"""


def test_entry_without_the_subpackage():
    for absent in (("corpus_pipeline", "hazardlens.llm"), ("corpus_pipeline",), ("hazardlens.llm",)):
        out = subprocess.run([sys.executable, "-c", WITHOUT % (ROOT, absent)], capture_output=True, text=True, timeout=120)
        assert out.stdout.strip() == "ok", out.stderr[-1000:]


def test_other_import_errors_are_not_swallowed():
    out = subprocess.run([sys.executable, "-c", WITHOUT % (ROOT, ("pyspark.sql",))], capture_output=True, text=True, timeout=120)
    assert out.returncode != 0 and "pyspark.sql" in out.stderr
