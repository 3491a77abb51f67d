import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p3_found", "p7_found"} <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_core_does_not_import_the_llm_package():
    for p in (ROOT / "studyloom").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "studyloom.llm" not in p.read_text(), p
    code = "import sys; sys.modules['studyloom.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p2_found' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
