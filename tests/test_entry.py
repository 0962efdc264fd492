"""The entry module without the optional subpackage."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT


def test_entry_imports_without_the_training_data_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert set(q) == set(s) and 'pipeline' not in q and 'fraud_events' in q, sorted(q)")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True, timeout=120)


def test_no_other_module_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "fraudmart")):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as f:
                    assert "fraudmart.llm" not in f.read(), n
