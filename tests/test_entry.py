"""The entry stands without the corpus operators, and without the libraries that only they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.modules[{0!r}] = None
import __spark_entry__ as e
print(sorted(n for n in e.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"), len(e.queries()) >= 49)
"""


@pytest.mark.parametrize("missing", ["tablesync.llm", "corpus_pipeline", "zstandard", "xxhash", "tiktoken", "sentencepiece"])
def test_without(missing):
    run = subprocess.run([sys.executable, "-c", CODE.format(missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.stdout.strip() == "[] True", run.stderr[-500:]


def test_other_errors_are_not_swallowed():
    run = subprocess.run([sys.executable, "-c", CODE.format("pyspark.sql.functions")], cwd=ROOT, capture_output=True,
                         text=True, timeout=120)
    assert run.returncode != 0
