"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["home_id", "status_label", "first_published_at", "last_published_at", "publications",
                          "taken_down_at", "days_online", "republished"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    exp, exp_cols = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert got_cols == exp_cols
    assert got == exp


@pytest.mark.parametrize("absent", ["xxhash", "public_tokenizers", "tablero.llm", "corpus_pipeline"])
def test_reports_need_no_package_of_the_training_data(absent):
    """Without a package of the training-data queries, all others are registered."""
    from tablero.plans.standins import ORACLES, REGISTRY
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(e.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(REGISTRY)), str(len(ORACLES))]
