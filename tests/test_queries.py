"""Every query with SQL against DuckDB, as the driver does."""

import duckdb
import pytest
from tests.conftest import SF

from lakeloom import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def lines(frame):
    f = frame[sorted(frame.columns)]
    plain = lambda v: str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return list(f.columns), sorted(str([plain(v) for v in r]) for r in f.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_oracle(spark, duck, name):
    assert lines(core.queries()[name](spark, SF).toPandas()) == lines(duck.execute(core.oracle_sql()[name]).df())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["source", "split", "n", "bytes"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_the_llm_subpackage():
    import subprocess
    import sys

    from tests.conftest import ROOT

    code = "import sys, lakeloom.queries, lakeloom.cli, lakeloom.plugins; assert not [m for m in sys.modules if m.startswith('lakeloom.llm')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_projection_reaches_the_scan(spark):
    plan = core.queries()["dir_size"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string,n_chars:bigint>" in plan.replace("n_chars:bigint,source:string", "source:string,n_chars:bigint")


def test_resume_is_an_anti_join(spark):
    plan = core.queries()["resume_anti"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
