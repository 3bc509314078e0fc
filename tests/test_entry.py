"""The driver contract without the optional package."""

import os
import shutil
import subprocess
import sys

import pytest

from orderloom.plans import queries  # noqa: F401  (registers the queries)
from orderloom.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), len(e.LLM_QUERIES))"


def _copy(to):
    shutil.copytree(os.path.join(ROOT, "orderloom"), to / "orderloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), to)
    return to


def _count(at):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=at, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(at)})


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "bytecode"])
def test_entry_without_the_package(tmp_path, left):
    at = _copy(tmp_path)
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    if left != "nothing":
        (at / "orderloom" / "llm" / "__pycache__").mkdir(parents=True)
        if os.path.exists(pipeline):
            shutil.copy(pipeline, at)
    if left == "bytecode":
        (at / "orderloom" / "llm" / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"")
    done = _count(at)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[0] == str(len(QUERIES)) and done.stdout.split()[2] == "0"


def test_other_import_errors_are_raised(tmp_path):
    at = _copy(tmp_path)
    (at / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    assert _count(at).returncode != 0
