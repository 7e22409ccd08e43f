"""The entry works whether or not the text operators are there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e, bench; print(len(e.queries()), len(e.oracle_sql()), sorted(e.queries())[-1])"


def copy_without(target, *left_out):
    def skip(folder, names):
        here = os.path.relpath(folder, ROOT)
        return [n for n in names if n in (".git", "__pycache__") or os.path.normpath(os.path.join(here, n)) in left_out]

    return shutil.copytree(ROOT, target, ignore=skip)


def asked(folder):
    return subprocess.run([sys.executable, "-B", "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("gone", [("mercastar/llm", "tests/llm"), ("mercastar/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_text_operators(tmp_path, gone):
    from mercastar.registry import QUERIES
    from oracles import ORACLES

    folder = copy_without(tmp_path / "copy", *gone)
    (tmp_path / "copy/mercastar/llm").mkdir()  # an empty folder may stay behind
    said = asked(folder)
    assert said.returncode == 0, said.stderr
    counts = said.stdout.split()
    assert [int(counts[0]), int(counts[1])] == [len(QUERIES), len(ORACLES)]


def test_a_broken_import_is_told(tmp_path):
    folder = copy_without(tmp_path / "copy")
    if not os.path.isdir(f"{folder}/mercastar/llm"):
        pytest.skip("no text operators")
    with open(f"{folder}/mercastar/llm/catalogue.py", "a") as file:
        file.write("\nimport a_module_that_is_not_there\n")
    said = asked(folder)
    assert said.returncode and "a_module_that_is_not_there" in said.stderr
