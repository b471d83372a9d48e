"""Every registered query against its DuckDB oracle at sf0.01 (row count, column names, value hash)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF01
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert len(srows) == len(drows)
    sh, scols = digest(df.columns, srows)
    dh, dcols = digest(dcols, drows)
    assert scols == dcols
    assert sh == dh


ANSI_SENSITIVE = ["lenient_int", "lenient_date", "code_label_text", "split_take", "consolidate_establishments",
                  "consolidate_movements", "parse_listing"]


@pytest.mark.parametrize("name", ANSI_SENSITIVE)
def test_same_results_with_ansi_off(spark, con, name):
    """The lenient forms are try_* expressions: results do not depend on the session's ANSI mode."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = entry.queries()[name](spark, SF01)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    res = con.execute(entry.oracle_sql()[name])
    assert digest(df.columns, srows) == digest([d[0] for d in res.description], res.fetchall())
