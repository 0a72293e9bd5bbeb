"""The entry works without the optional subpackage, and reports errors inside it."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT


def copy(to):
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))


def run(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": folder})


NAMES = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"


def test_without_the_subpackage(scratch):
    from hearth.plans import catalog, oracle
    folder = os.path.join(scratch, "repo")
    copy(folder)
    out = run(folder, NAMES)
    assert out.stdout.split() == [str(len(catalog.QUERIES)), str(len(oracle.SQL))], out.stderr[-2000:]


def test_a_broken_subpackage_is_an_error(scratch):
    folder = os.path.join(scratch, "repo")
    copy(folder)
    os.makedirs(os.path.join(folder, "hearth", "llm"))
    open(os.path.join(folder, "hearth", "llm", "__init__.py"), "w").close()
    assert run(folder, NAMES).returncode != 0
