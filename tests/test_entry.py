"""The library works without the training-data folders."""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), any(q.startswith('op') for q in e.queries()))"


def copied(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", ".pytest_cache"))
    for path in (copy / "capturelake/llm", copy / "tests/llm"):
        shutil.rmtree(path, ignore_errors=True)
    return copy


def run(copy, *args):
    # what the parent finds on its path, the child finds behind the copy
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(copy), *(p for p in sys.path if p and os.path.realpath(p) != os.path.realpath(ROOT))])}
    return subprocess.run([sys.executable, *args], cwd=copy, capture_output=True, text=True, timeout=900, env=env)


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_llm(tmp_path, with_pipeline):
    """With and without corpus_pipeline.py, which imports what is gone."""
    copy = copied(tmp_path)
    if not with_pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    out = run(copy, "-c", COUNT)
    assert out.returncode == 0, out.stderr
    n, sql, pipeline, ops = out.stdout.split()
    assert int(n) > 55 and int(sql) > 55 and (pipeline, ops) == ("False", "False")


def test_the_rest_passes_without_llm(tmp_path):
    """Some tests of the library, in a process of their own; nothing in it needs the folders."""
    copy = copied(tmp_path)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    out = run(copy, "-m", "pytest", "-x", "-q", "-p", "no:cacheprovider", "tests/test_library.py", "tests/test_catalogue.py", "-k", "mime or urls or test_search or merge_captures or link_edges or config")
    assert out.returncode == 0, out.stdout[-3000:]


def test_nothing_in_the_library_names_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "capturelake")):
        if os.path.basename(folder) != "llm":
            for name in (n for n in names if n.endswith(".py")):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert not re.search(r"\bllm\b", f.read()), name
