"""The entry with and without the optional training-data operators, in copies of the repository."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def said(path):
    return subprocess.run([sys.executable, "-c", SAYS], cwd=path, capture_output=True, text=True, timeout=120)


def copied(path, *left_out):
    def ignored(folder, names):
        here = os.path.relpath(folder, ROOT)
        gone = {n for n in names if os.path.normpath(os.path.join(here, n)) in left_out}
        return gone | {n for n in names if n in (".git", "__pycache__", "spark-warehouse")}

    shutil.copytree(ROOT, path, ignore=ignored)
    return path


@pytest.mark.parametrize("left_out", [("opsignals/llm", "tests/llm", "corpus_pipeline.py"), ("opsignals/llm", "tests/llm")])
def test_entry_without_the_optional_operators(tmp_path, left_out):
    run = said(copied(tmp_path / "repo", *left_out))
    assert run.returncode == 0, run.stderr
    names, sql = (set(line.split()) for line in run.stdout.splitlines())
    assert len(names) >= 47 and names == sql
    assert not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names


def test_entry_does_not_hide_a_broken_module(tmp_path):
    repo = copied(tmp_path / "repo")
    if not os.path.isdir(repo / "opsignals" / "llm"):
        pytest.skip("without the optional operators")
    (repo / "opsignals" / "llm" / "queries.py").write_text("import no_such_module\n")
    run = said(repo)
    assert run.returncode != 0 and "no_such_module" in run.stderr
