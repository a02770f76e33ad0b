"""The library without its optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).parents[1]


def test_the_rest_stands_without_the_corpus_operators(tmp_path):
    ignored = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    copy = shutil.copytree(REPO, tmp_path / "copy", ignore=ignored)
    run = lambda *command: subprocess.run(
        [sys.executable, *command], cwd=copy, capture_output=True, text=True, timeout=300
    )
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    for pipeline in (True, False):
        if not pipeline:
            (copy / "corpus_pipeline.py").rename(tmp_path / "unused.py")
        entry = run("-c", code)
        assert entry.returncode == 0, entry.stderr
        assert entry.stdout.split()[1] == "False"
        collected = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
        assert collected.returncode == 0, collected.stdout[-2000:]


def test_all_tests_are_collected_together():
    done = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=REPO,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stdout[-2000:]
