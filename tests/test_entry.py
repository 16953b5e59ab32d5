"""The entry points with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_everything_else_works_without_them(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "tapeworks", copy / "tapeworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *[q for q in e.queries() if q[:2] == 'op' and q[2].isdigit()])"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, oracles, *others = run.stdout.split()
    assert queries == oracles and int(queries) > 60 and not others


def test_an_error_inside_them_is_not_swallowed(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "tapeworks", copy / "tapeworks", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    (copy / "corpus_pipeline.py").write_text("import a_library_that_is_not_there")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert "a_library_that_is_not_there" in run.stderr
