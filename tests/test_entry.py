"""The entry points with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["partsieve/llm"], ["partsieve/llm", "corpus_pipeline.py"]])
def test_queries_without_the_operators(tmp_path, gone):
    shutil.copytree(ROOT / "partsieve", tmp_path / "partsieve", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    for name in gone:
        path = tmp_path / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'pipeline' not in q and set(o) <= set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) > 100
