"""The entry points without the text part: other queries are there and nothing fails to import."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True, timeout=120).stdout.split()


def test_entry_without_the_text_part(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", "tests", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "without", ignore=skip)
    skip = shutil.ignore_patterns("llm", "tests", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "pipeline_only", ignore=skip)
    found = names(tmp_path / "without")
    assert len(found) >= 79 and found == names(tmp_path / "pipeline_only")
    assert not any(x.startswith("op") and x[2].isdigit() or x == "pipeline" for x in found)
