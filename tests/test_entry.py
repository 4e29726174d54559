"""The entry point works in a fresh process, without a session and without Spark's jars in reach."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
CODE = """
import pathlib
real = pathlib.Path.glob
pathlib.Path.glob = lambda self, pattern, **k: iter(()) if "jar" in str(pattern) else real(self, pattern, **k)
import __spark_entry__ as e
from pyspark import SparkContext
queries, sql = e.queries(), e.oracle_sql()
assert SparkContext._active_spark_context is None
assert set(sql) <= set(queries) and len(queries) >= 84, len(queries)
assert all(isinstance(s, str) and s.strip() for s in sql.values())
print("fine")
"""


def test_entry_point_without_session_or_jars():
    done = subprocess.run([sys.executable, "-c", CODE], cwd=REPO, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr
