"""The driver's contract: imports, stable schemas, and every query against its SQL."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
REPO = Path(__file__).resolve().parents[1]


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(norm, v))
    return v


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    df = entry.queries()[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = Counter(repr([norm(r[c]) for c in cols]) for r in df.collect())
    res = con.execute(entry.oracle_sql()[name])
    have = [d[0] for d in res.description]
    assert sorted(have) == cols
    want = Counter(repr([norm(float(r[have.index(c)]) if type(r[have.index(c)]).__name__ == "Decimal" else r[have.index(c)]) for c in cols]) for r in res.fetchall())
    assert got == want


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_core_stands_alone():
    """Without the llm subpackage the rest imports, and the driver's entry has the core's queries."""
    code = "import sys; sys.modules['quire.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p6_found' in q and 'p4_found' not in q; assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=REPO, env=os.environ | {"PYTHONPATH": str(REPO)}).returncode == 0


def test_core_does_not_import_llm():
    for f in (REPO / "quire").rglob("*.py"):
        if "llm" not in f.relative_to(REPO).parts:
            assert "quire.llm" not in f.read_text(), f


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_workers_need_no_installation(tmp_path):
    """A driver started in another folder, whose workers know nothing of this one, still runs Python operators."""
    code = (
        f"import sys; sys.path.insert(0, {str(REPO)!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession;"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate();"
        f"print('rows', e.queries()['document_blocks'](s, {str(DATA)!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "rows " in done.stdout, done.stderr[-2000:]
