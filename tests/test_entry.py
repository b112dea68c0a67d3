"""The driver's entry module on copies of the repository without optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
import __spark_entry__ as entry
from salescast.session import get_session
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert sql <= names, sql - names
spark = get_session("local[2]", "entry", {"spark.sql.shuffle.partitions": "2"})
assert entry.entry(spark).count() > 0
print("found", len(names), sum(n.startswith("op") for n in names), "pipeline" in names)
"""


@pytest.mark.parametrize("gone", [("salescast/llm", "tests/llm"), ("salescast/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_works_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__") or
                                                              os.path.relpath(os.path.join(folder, n), REPO) in gone])
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", PROGRAM], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    found = run.stdout.split("found ")[1].split()
    there = "salescast/llm" not in gone and os.path.isdir(os.path.join(REPO, "salescast", "llm"))
    assert found[2] == "False" and (int(found[1]) > 0) == there
