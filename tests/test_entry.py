from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOWN = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), len(o), sum(k.startswith("op") or k == "pipeline" for k in [*q, *o]))
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_works_without_the_training_data_folders(tmp_path, pipeline):
    """A copy without ``llm``, with and without the pipeline that needs it."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])))
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", SHOWN], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 60 and int(out[1]) > 60 and out[2] == "0"
    assert subprocess.run([sys.executable, "-c", "import tests.test_queries"], cwd=copy, env=env).returncode == 0


def test_errors_inside_an_optional_module_are_not_hidden(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    (tmp_path / "copy/quaestor/llm").mkdir()
    (tmp_path / "copy/quaestor/llm/__init__.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", SHOWN], cwd=tmp_path / "copy", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "copy")})
    assert done.returncode and "no_such_module" in done.stderr
