"""Every catalogue query with an oracle: Spark result == DuckDB result over
the same parquet tables (row count, column names, order-insensitive hash)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

ORACLES = entry.oracle_sql()


def test_every_query_is_registered_with_a_callable():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert all(callable(f) for f in qs.values())


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    assert digest(df.columns, srows) == digest(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "prediction"]
    assert df.count() > 0


def test_entry_imports_and_stemming_runs_outside_the_repo():
    """The driver may import the entry module before any session exists and
    from another working directory."""
    import subprocess
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "from pairscore.operators.stemming import stem_tokens\n"
        "df = s.createDataFrame([(1, ['running', 'ponies'])], 'k long, t array<string>')\n"
        "print(stem_tokens(df, 'k', 't', 'x').first().x)\n" % repo)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=300, cwd="/")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "['run', 'poni']" in out.stdout
