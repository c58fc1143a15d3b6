"""The report library works without the training-data operators: on copies of the repository without them."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as E; print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))"


def _copy(tmp_path, *without):
    def left_out(folder, names):
        here = os.path.relpath(folder, ROOT)
        return [n for n in names if n in ("__pycache__", ".git") or os.path.normpath(os.path.join(here, n)) in without]

    return shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)


def _show(root):
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    names, sql = out.stdout.splitlines()
    return set(names.split()), set(sql.split())


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_queries_without_the_folders(tmp_path, pipeline_too):
    gone = ["shelfaudit/llm", "tests/llm"] + ["corpus_pipeline.py"] * pipeline_too
    names, sql = _show(_copy(tmp_path, *gone))
    from shelfaudit.catalog.forms import QUERIES

    assert names == QUERIES.keys() and sql == QUERIES.keys()


def test_broken_operators_are_an_error(tmp_path):
    root = _copy(tmp_path)
    if not os.path.isdir(root / "shelfaudit/llm"):
        pytest.skip("the operators are not there")
    (root / "shelfaudit/llm/queries.py").write_text("import no_such_module\n")
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, timeout=120)
    assert "no_such_module" in out.stderr


def test_no_test_imports_a_conftest_by_its_bare_name():
    for folder, _, names in os.walk(os.path.join(ROOT, "tests")):
        for n in names:
            if n.endswith(".py"):
                lines = open(os.path.join(folder, n)).read().splitlines()
                assert not any(x.startswith(("from conftest", "import conftest")) for x in lines), n
