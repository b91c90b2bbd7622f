"""The driver's contract, with and without the subpackage for training data."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_every_scan_query_has_sql():
    from lakelens.queries import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)


def test_entry_imports_without_llm():
    code = "import sys; sys.modules['lakelens.llm'] = None; import __spark_entry__ as e; assert 'scan_latest' in e.queries() and not any(x.startswith('op') for x in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
