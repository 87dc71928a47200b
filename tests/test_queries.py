import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from conftest import rows
from vitalgrid.sources import requests
from vitalgrid.workload import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLE_QUERIES = {name: query for name, query in queries().items() if name in all_queries()}


@pytest.fixture(scope="module")
def con():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(TABLE_QUERIES))
def test_query_equals_its_sql(spark, con, name):
    ok, message = check.compare(spark, con, FOLDER, name, queries()[name], oracle_sql()[name])
    assert ok, message


def test_entry(spark):
    assert entry(spark).columns == ["origin_iso3", "destination_iso3", "date", "flight_count", "estimated_passengers"]


def test_no_cross_join_and_no_python_in_any_plan(spark):
    for name, query in TABLE_QUERIES.items():
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "SinglePartition, ENSURE"):
            if bad.startswith("SinglePartition") and name == "load_metrics":
                continue
            assert bad not in plan, (name, bad)


def test_run_delete_gives_rows_and_totals(spark, tmp_path):
    orders = [(1, "F"), (2, "P"), (3, "O"), (3, "O"), (4, None), (None, "F")]
    points = [(1, 1, 5.0), (1, 2, 7.0), (2, 1, 100.0), (3, 1, 2.0), (3, None, 4.0), (3, None, None), (4, 1, 50.0), (None, 1, 60.0), (9, 1, 70.0)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(points, "l_orderkey bigint, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries()["run_delete"](spark, str(tmp_path))
    assert rows(got, "run_id", "t", "infected", "points_at_t", "infected_at_t") == [
        (1, 1, 5, 2, 7), (1, 2, 7, 1, 7), (3, 1, 2, 2, 7), (3, None, 4, 2, 4), (3, None, None, 2, 4),
    ]


def test_request_manifest_expands_after_grouping(spark, tmp_path):
    keys = [(k,) for k in (1, 2, 2, None, None, None)]
    spark.createDataFrame(keys, "s_suppkey bigint").write.parquet(f"{tmp_path}/supplier.parquet")
    df = queries()["request_manifest"](spark, str(tmp_path))
    got = rows(df, "iso3", "age_code", "files", "last_name")
    assert len(got) == 60 and {(iso3, n) for iso3, _, n, _ in got} == {("S1", 12), ("S2", 24), (None, 36)}
    assert got[0] == ("S1", "00", 12, "s1_t_00_2026_CN_100m_R2025A_v1.tif")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Requests are neither sorted nor exchanged.
    assert "Sort" not in plan and plan.index("Generate") < plan.index("HashAggregate")
    assert plan.count("Exchange ") == 1


def test_age_requests_together_are_the_same_requests(spark):
    countries = spark.createDataFrame([("FRA",), ("FRA",), (None,)], "iso3 string")
    apart = requests.age_requests(countries, (2019, 2021))
    together = requests.age_requests(countries, (2019, 2021), together=True)
    assert rows(together.selectExpr("iso3", "age_code", "inline(requests)"), *apart.columns) == rows(apart)
