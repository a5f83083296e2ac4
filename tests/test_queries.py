"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import glob
import os

import pytest

from taxolith.queries import cohorts, core, formats, reads, statistics  # noqa: F401  (all register their queries in core)

FOLDER = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return repr(float(value)) if isinstance(value, float) or type(value).__name__ == "Decimal" else value


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(core.SQL))
def test_matches_sql(spark, duck, name):
    df = core.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(([plain(v) for v in r] for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted(([plain(v) for v in r] for r in duck.sql(f"SELECT {names} FROM ({core.SQL[name]})").fetchall()), key=repr)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_queries_without_sql_take_all_rows(spark):
    assert core.QUERIES["cmp20_host_microbe"](spark, FOLDER).select("gene").distinct().count() == 97
    own, _ = core.clusters(spark, FOLDER)
    assert own.count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey").distinct().count()


def test_merged_intervals_with_ties(spark, tmp_path):
    """Which of equal intervals comes first is left open, and changes nothing."""
    import duckdb

    path = str(tmp_path / "orders.parquet")
    day = "TIMESTAMP '2000-01-01' + INTERVAL (CAST(k // 3 * 90 + c % 7 AS INTEGER)) DAY"
    duckdb.sql(f"COPY (SELECT c * 100 + k AS o_orderkey, c AS o_custkey, {day} AS o_orderdate FROM RANGE(20000) a(c), RANGE(18) b(k)) TO '{path}' (FORMAT PARQUET)")
    got = core.QUERIES["win6_merge_intervals"](spark, str(tmp_path))
    assert got.count() == 20000 * 6 and got.where("end - start = 60").count() == 20000 * 6
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}'")
    assert con.sql(f'SELECT COUNT(*), COUNT(*) FILTER (WHERE "end" - "start" = 60) FROM ({core.SQL["win6_merge_intervals"]})').fetchall() == [(20000 * 6, 20000 * 6)]
