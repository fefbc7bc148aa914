"""The entry point without the training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = "import __spark_entry__ as e; print(len(e.queries()), 'units_per_parcel' in e.queries(), any(k.startswith('op') for k in e.queries()))"


@pytest.mark.parametrize("gone", [("corpus_pipeline.py",), ()])
def test_imports_without_llm_folders(tmp_path, gone):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *gone)
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", CODE], cwd=tmp_path / "copy", env=env, capture_output=True, text=True
    )
    assert run.returncode == 0, run.stderr
    n, has_units, has_ops = run.stdout.split()
    assert int(n) > 60 and has_units == "True" and has_ops == "False"


def test_a_broken_operator_is_not_swallowed(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    catalog = tmp_path / "copy" / "lotwise" / "llm" / "catalog.py"
    if not catalog.exists():
        pytest.skip("no training-data folder")
    catalog.write_text("import no_such_module_here\n")
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert run.returncode != 0 and "no_such_module_here" in run.stderr
