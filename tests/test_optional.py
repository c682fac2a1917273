"""The rest works where the training-data operators have been taken away."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [["recordforge/llm"], ["recordforge/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"], []])
def test_queries_without_the_folders(tmp_path, gone):
    for name in ("recordforge", "__spark_entry__.py", "corpus_pipeline.py"):
        src = ROOT / name
        if src.is_dir():
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif src.exists():
            shutil.copy(src, tmp_path / name)
    for name in gone:
        path = tmp_path / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), 'pipeline' in q, any(k.startswith('op1_') for k in q)); assert set(o) <= set(q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    has_llm = (tmp_path / "recordforge/llm").exists()
    assert out[2:] == [str(has_llm and (tmp_path / "corpus_pipeline.py").exists()), str(has_llm)] and int(out[0]) > 100
