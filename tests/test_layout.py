"""The library stands without the language-model subpackage, and nothing else imports it."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_llm():
    for path in (ROOT / "parcelwright").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"parcelwright\.llm|from \.+llm|corpus_pipeline", path.read_text()), path


def test_entry_without_llm(tmp_path):
    for name in ("parcelwright", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    said = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(x.startswith('op') for x in e.queries()))"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, m, ops = said.stdout.split()
    assert n == m and int(n) > 90 and ops == "False"
