"""The contract of the entry module where the training-data subpackage, the pipeline or both are absent."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q, set(o) <= set(q))"


def _kept(*left_out):
    return lambda folder, names: {n for n in names if n in ("__pycache__", ".git") or Path(folder, n).relative_to(ROOT).as_posix() in left_out}


@pytest.mark.parametrize("left_out", [("millrace/llm",), ("millrace/llm", "corpus_pipeline.py")])
def test_entry_without_training_data(tmp_path, left_out):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=_kept(*left_out, "tests"))
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, numbered, pipeline, known = out.stdout.split()
    assert int(queries) >= 208 and (numbered, pipeline, known) == ("0", "False", "True")


def test_entry_with_an_empty_folder_left_behind(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=_kept("millrace/llm", "tests"))
    (copy / "millrace/llm/__pycache__").mkdir(parents=True)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and out.stdout.split()[1:] == ["0", "False", "True"], out.stderr
