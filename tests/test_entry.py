import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_contract(spark):
    assert entry.entry(spark).count() == 6
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and len(names) > 80


def test_imports_without_the_optional_parts(tmp_path):
    """As it is when the subpackage and the pipeline are gone."""
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    (tmp_path / "gridlark").mkdir()
    for part in (ROOT / "gridlark").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "gridlark" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) == set(q)"
    env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_optional_parts():
    for path in (ROOT / "gridlark").rglob("*.py"):
        if "llm" not in path.parts:
            assert "gridlark.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
