"""The entry module stands without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_training_data_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "*.json", "*.txt"))
    # corpus_pipeline.py is still there and cannot be imported
    say = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", say], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, checked, extra = out.stdout.split()
    assert int(n) >= 168 and n == checked and extra == "False"
