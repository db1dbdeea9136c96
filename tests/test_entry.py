"""The driver's entry without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder) -> list[str]:
    code = "import __spark_entry__ as e; print(' '.join(sorted(e.queries())))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def _copy(to, *drop):
    skip = shutil.ignore_patterns("__pycache__", ".git", "*.json", *drop)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in drop and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", to)
    shutil.copytree(f"{ROOT}/vendorscope", to / "vendorscope", ignore=skip)
    return to


def test_entry_without_the_package_keeps_all_other_queries(tmp_path):
    from vendorscope.plans.catalog import all_queries
    # corpus_pipeline.py may stay behind when the folders are taken away.
    assert _names(_copy(tmp_path, "llm")) == sorted(all_queries())


def test_entry_without_the_pipeline(tmp_path):
    names = _names(_copy(tmp_path, "corpus_pipeline.py"))
    assert "pipeline" not in names and "page_to_answer" in names
