"""The entry point in copies of the repository without the optional training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
OPTIONAL = ["catalog_signals/llm", "tests/llm", "corpus_pipeline.py"]


def _copy_without(tmp_path, removed):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "*.json"))
    for name in removed:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    return copy


def _run(copy, *command):
    return subprocess.run([sys.executable, *command], cwd=copy, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize("removed", [OPTIONAL, OPTIONAL[:2], OPTIONAL[:1]])
def test_the_rest_imports_and_is_collected_alone(tmp_path, removed):
    copy = _copy_without(tmp_path, removed)
    listed = _run(
        copy, "-c",
        "import __spark_entry__ as e; from verification.queries import QUERIES; "
        "assert e.queries().keys() == QUERIES.keys() == e.oracle_sql().keys(), e.queries().keys()",
    )
    assert listed.returncode == 0, listed.stderr
    collected = _run(copy, "-m", "pytest", "tests", "--collect-only", "-q", "--ignore=tests/llm")
    assert collected.returncode == 0, collected.stdout


def test_an_empty_folder_left_behind_is_no_code(tmp_path):
    copy = _copy_without(tmp_path, OPTIONAL[:1])
    (copy / "catalog_signals/llm/__pycache__").mkdir(parents=True)
    assert _run(copy, "-c", "import __spark_entry__ as e; assert 'pipeline' not in e.queries()").returncode == 0
