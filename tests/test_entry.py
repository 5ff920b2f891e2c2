"""The entry without the optional operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LEAVE = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "*.json", "*.txt", "spark-warehouse")


def test_entry_imports_without_the_optional_operators(tmp_path):
    left = tmp_path / "left"
    shutil.copytree(ROOT, left, ignore=LEAVE)
    code = ("import __spark_entry__ as e, bench, checks.compare; n = e.queries(); assert 'search_lexical' in n; "
            "assert set(e.oracle_sql()) <= set(n); assert not [k for k in n if k.startswith('op') or k == 'pipeline']")
    for _ in range(2):  # with the pipeline's file, and without it
        done = subprocess.run([sys.executable, "-c", code], cwd=left, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        (left / "corpus_pipeline.py").unlink(missing_ok=True)
