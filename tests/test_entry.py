"""The entry module with and without the optional subpackage, in a copy of the repository."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CORE = {"fetch_kofia_market_funds", "stored_replace", "page_audit"}


def names(tmp_path, *without):
    """Names of the queries, as a copy of the repository without some of its parts sees them."""
    copy = tmp_path / "repo"
    left_out = [os.path.join(ROOT, x) for x in without]

    def ignore(folder, entries):
        return [e for e in entries if os.path.join(folder, e) in left_out or e.startswith((".git", "__pycache__", "spark-warehouse", ".pytest"))]

    shutil.copytree(ROOT, copy, ignore=ignore)
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout
    tests = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"], cwd=copy, env=env, capture_output=True, text=True)
    assert tests.returncode == 0, tests.stdout[-2000:]
    return set(out.split())


@pytest.mark.parametrize("without", [["portalake/llm", "tests/llm"], ["portalake/llm", "tests/llm", "corpus_pipeline.py"]])
def test_without_the_text_operators(tmp_path, without):
    found = names(tmp_path, *without)
    assert CORE <= found and not any(n.startswith("op") or n == "pipeline" for n in found)


def test_without_the_pipeline_alone(tmp_path):
    found = names(tmp_path, "corpus_pipeline.py", "tests/llm")
    has = os.path.isdir(os.path.join(ROOT, "portalake", "llm"))
    assert CORE <= found and "pipeline" not in found and any(n.startswith("op") for n in found) == has
