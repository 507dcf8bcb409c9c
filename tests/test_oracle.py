"""Every registered query against its DuckDB oracle on the smallest fixture.

Spark and DuckDB run in separate processes (tools/oracle_check.py)."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registered_queries_match_oracle():
    p = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"),
                        "/root/testdata/sf0.001"], capture_output=True, text=True, timeout=1800)
    assert p.returncode == 0, p.stdout[-4000:] + p.stderr[-2000:]
    assert "mismatches: 0" in p.stdout


def test_entry_contract():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    from verity.registry import QUERIES
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(sql) <= set(qs)


def test_entry_smoke(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == \
        [("year", "string"), ("month", "string"), ("revenue", "double"), ("orders", "bigint")]
