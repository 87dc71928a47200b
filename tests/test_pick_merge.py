from pyspark.sql import functions as F

from conftest import rows
from vitalgrid import schemas
from vitalgrid.operators import merge, pick, resolve


def test_latest_keeps_nulls_of_its_row(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("b", 1, 1.0)], "k string, t int, v double")
    assert rows(pick.latest_per_key(df, ["k"], ["t"])) == [("a", 2, None), ("b", 1, 1.0)]


def test_last_and_first_write(spark):
    df = spark.createDataFrame([("a", 1, 0, 5), ("a", 1, 3, 6), ("a", 0, 9, 7)], "k string, p int, i int, v int")
    assert rows(pick.last_write_wins(df, ["k"], ["p", "i"])) == [("a", 6)]
    assert rows(pick.first_write_wins(df, ["k"], ["p", "i"])) == [("a", 7)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 100000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    out = pick.latest_per_key(df, ["k"], ["t"])
    assert rows(out) == [("hot", 99999, 199998)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_first_n_text(spark):
    df = spark.createDataFrame([("a", f"x{i:02d}") for i in range(12)] + [("b", "y")], "k string, v string")
    got = dict(rows(pick.first_n_text(df, ["k"], "v", 10)))
    assert got["b"] == "y" and got["a"] == ", ".join(f"x{i:02d}" for i in range(10)) + " ..."
    plan = pick.first_n_text(df, ["k"], "v", 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def stored(spark):
    return spark.createDataFrame(
        [("a", 1.0, "old", "OLD"), ("b", 2.0, "old", "OLD")], "k string, v double, name string, source string"
    )


def test_upsert_null_overwrites_and_unnamed_columns_stay(spark):
    new = spark.createDataFrame(
        [("a", 9.0, "x", 0), ("a", None, "new", 1), ("c", 3.0, "new", 0)], "k string, v double, name string, o int"
    )
    got = merge.upsert(stored(spark), new, ["k"], ["v"], {"source": F.lit("NEW")}, order=["o"])
    want = [("a", None, "old", "OLD"), ("b", 2.0, "old", "OLD"), ("c", 3.0, "new", "NEW")]
    assert rows(got) == want
    again = merge.upsert(got, new, ["k"], ["v"], {"source": F.lit("NEW")}, order=["o"])
    assert rows(again) == want


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 9.0, "n", "N", 0), ("c", 1.0, "n", "N", 1), ("c", 2.0, "n", "N", 2)], "k string, v double, name string, source string, o int")
    got = merge.insert_if_absent(stored(spark), new, ["k"], ["o"])
    assert rows(got, "k", "v") == [("a", 1.0), ("b", 2.0), ("c", 1.0)]


def test_replace_slices_keeps_untouched_slices(spark):
    ddl = "iso3 string, year int, age int, release string"
    old = spark.createDataFrame([("A", 1, 15, "old"), ("A", 1, 20, "other"), ("A", 2, 15, "old")], ddl)
    new = spark.createDataFrame([("A", 1, 15, "new")], ddl)
    assert rows(merge.replace_slices(old, new, ["iso3", "year"])) == [("A", 1, 15, "new"), ("A", 2, 15, "old")]


def test_set_column_updates_every_row(spark):
    old = spark.createDataFrame([(1, "raw", "f", None), (2, "raw", "f", 5.0), (3, "cog", "f", 1.0)], "id int, stage string, filename string, exact_total double")
    new = spark.createDataFrame([("raw", "f", 7.0)], "stage string, filename string, exact_total double")
    got = merge.set_column(old, new, ["stage", "filename"], "exact_total")
    assert rows(got, "id", "exact_total") == [(1, 7.0), (2, 7.0), (3, 1.0)]


def test_evolve_is_idempotent(spark):
    old = spark.createDataFrame([("A", 2020, 15, 19, 1.0)], "iso3 string, year int, age_min int, age_max int, asfr double")
    fill = {"variant_short_name": "MEDIAN"}
    once = merge.evolve(old, schemas.FERTILITY.schema, fill)
    assert once.columns == schemas.FERTILITY.columns
    assert rows(once) == rows(merge.evolve(once, schemas.FERTILITY.schema, fill))
    assert once.first().variant_short_name == "MEDIAN"


def test_cascade_delete(spark):
    runs = spark.createDataFrame([("r1",)], "id string")
    points = spark.createDataFrame([("r1", 0.0), ("r2", 0.0)], "run_id string, t double")
    assert rows(merge.cascade_delete(runs, points, "id", "run_id")) == [("r1", 0.0)]


def test_resolve(spark):
    import pytest

    offered = spark.createDataFrame([("FRA", 5, 1), ("fra", 4, 0), ("DEU", 6, 2)], "iso3 string, id int, _ord int")
    wanted = spark.createDataFrame([("fra",)], "iso3 string")
    assert rows(resolve.resolve(wanted, offered, "iso3", ignore_case=True)) == [("fra", 4)]
    missing = spark.createDataFrame([("ITA",)], "iso3 string")
    with pytest.raises(Exception, match="no id for iso3 ITA"):
        resolve.resolve(missing, offered, "iso3").collect()
    assert rows(resolve.resolve(missing, offered, "iso3", strict=False)) == [("ITA", None)]
