"""The entry point without the optional training-data part."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules[{name!r}] = None  # importing it now fails
import warnings
warnings.simplefilter("ignore")
import __spark_entry__ as E
q = E.queries()
print(len(q), "user_base_table" in q, any(k.startswith("op") for k in q), sorted(set(E.oracle_sql()) - set(q)))
"""


def run(name):
    out = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-1500:]
    return out.stdout.split()


def test_a_missing_dependency_leaves_the_analytics_queries():
    for name in ("regex", "lapse.llm", "corpus_pipeline"):
        n, base, ops, extra = run(name)
        assert int(n) >= 66 and base == "True" and extra == "[]", name
        assert ops == str(name == "corpus_pipeline"), name
