"""The registry can be read before any session exists."""

from __future__ import annotations

import os
import subprocess
import sys


def test_registry_needs_no_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and 'gene_tables' in q"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
