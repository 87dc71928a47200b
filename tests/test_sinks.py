import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from vitalgrid import schemas
from vitalgrid.plans import covid
from vitalgrid.refdata import COVID_METRICS
from vitalgrid.sinks import csvfiles as out_csv
from vitalgrid.sinks import fs, ordered, rewrite, tables
from vitalgrid.sources import csvfiles, listing
from vitalgrid.sources import tables as source
from vitalgrid.streaming import landed

def t0():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def t1():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def wb(spark, data):
    return spark.createDataFrame(data, "iso3 string, indicator_code string, indicator_name string, year int, value double, _o int")


def test_upsert_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "wb")
    tables.upsert(schemas.WORLDBANK, path, wb(spark, [("A", "i", "n", 2000, 1.0, 0), ("A", "i", "n", 2001, 2.0, 0), ("B", "i", "n", 2000, 5.0, 0)]), t0(), ["_o"])
    kept = {os.path.basename(f) for f in glob.glob(path + "/year=2001/*.parquet")}
    tables.upsert(schemas.WORLDBANK, path, wb(spark, [("A", "i", "n2", 2000, 9.0, 0), ("A", "i", "n2", 2000, 8.0, 1), ("C", "i", "n", 2002, 3.0, 0)]), t1(), ["_o"])
    assert {os.path.basename(f) for f in glob.glob(path + "/year=2001/*.parquet")} == kept
    got = rows(source.read(spark, schemas.WORLDBANK, path), "iso3", "year", "value", "indicator_name", "source", "created_at")
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    assert got == [
        ("A", 2000, 8.0, "n2", "WORLDBANK", old), ("A", 2001, 2.0, "n", "WORLDBANK", old),
        ("B", 2000, 5.0, "n", "WORLDBANK", old), ("C", 2002, 3.0, "n", "WORLDBANK", new),
    ]
    assert rewrite.recompress(spark, path, "snappy")[0] == "ok" and fs.partition_columns(spark, path) == ["year"]
    assert rewrite.recompress(spark, path, "snappy")[0] == "skip"
    tables.upsert(schemas.WORLDBANK, path, wb(spark, [("A", "i", "n3", 2000, 7.0, 0)]), t1(), ["_o"])
    fresh = wb(spark, [("A", "i", "n4", 2000, 1.0, 0), ("D", "i", "n", 2003, 4.0, 0)])
    before = {os.path.basename(f) for f in glob.glob(path + "/year=2001/*.parquet")}
    tables.insert_if_absent(schemas.WORLDBANK, path, fresh, ["_o"], t1())
    assert {os.path.basename(f) for f in glob.glob(path + "/year=2001/*.parquet")} == before
    after = rows(source.read(spark, schemas.WORLDBANK, path), "iso3", "year", "value", "source")
    assert after == [(c, y, v, "WORLDBANK") for c, y, v in (("A", 2000, 7.0), ("A", 2001, 2.0), ("B", 2000, 5.0), ("C", 2002, 3.0), ("D", 2003, 4.0))]


def test_covid_csv_to_latest(spark, tmp_path):
    lines = [
        "iso_code,continent,date,total_cases,new_cases,total_deaths",
        'FRA,"Eu""r,ope",2020-01-01,5,1,',
        "fra ,E,2020-01-02,,0,",
        "OWID_WRL,E,2020-01-01,9,9,9",
        ",E,2020-01-01,9,9,9",
        "FRA,E,2020-1-3,9,9,9",
        "FRA,E,2020-13-01,9,9,9",
        "FRA,E,2020-01-04,,,x",
        "FRA,E,2020-01-01,,2,7",
        "DEU,E,2020-01-01,1,1,1",
    ]
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    raw = csvfiles.covid(spark, str(tmp_path / "c.csv"))
    path, last = str(tmp_path / "daily"), str(tmp_path / "latest")
    tables.upsert(schemas.COVID, path, covid.daily_rows(raw, ["FRA"]), t0(), ["_file", "_line"])
    daily = source.read(spark, schemas.COVID, path)
    d = dt.date
    assert rows(daily, "iso3", "date", "total_cases", "new_cases", "total_deaths", "icu_patients", "source") == [
        ("FRA", d(2020, 1, 1), None, 2.0, 7.0, None, "OWID"),
        ("FRA", d(2020, 1, 2), None, 0.0, None, None, "OWID"),
    ]
    for stamp in (t0(), t1()):
        tables.upsert(schemas.COVID_LATEST, last, covid.country_latest(daily, stamp), stamp)
    got = rows(source.read(spark, schemas.COVID_LATEST, last), "iso3", "last_date", "total_deaths", "source", "updated_at")
    assert got == [("FRA", d(2020, 1, 2), None, "OWID", dt.datetime(2024, 2, 1))]
    assert len(COVID_METRICS) == 22


def test_file_order_over_many_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("type,ident\n" + "".join(f"t,{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = csvfiles.with_file_order(csvfiles.text_csv(spark, str(tmp_path / "big.csv")))
        assert df.rdd.getNumPartitions() > 3
        got = [int(r.ident) for r in df.orderBy("_file", "_line").select("ident").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(20000))


def test_airport_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"id","ident","type","name","latitude_deg"\n1,"LFPG","large_airport","Paris, ""CDG""\nline two",49.1\n')
    got = csvfiles.airports(spark, str(tmp_path / "a.csv")).first()
    assert (got.ident, got.name, got.latitude_deg, got.iso_country) == ("LFPG", 'Paris, "CDG"\nline two', "49.1", None)


def fertility(spark, data):
    return spark.createDataFrame(data, "iso3 string, year int, variant_short_name string, age_min int, age_max int, asfr double, source string, release string")


def test_replace_slices_on_disk(spark, tmp_path):
    path = str(tmp_path / "asfr")
    old = [("A", 1, "MEDIAN", 15, 19, 1.0, "UN_WPP", "2022"), ("A", 1, "MEDIAN", 20, 24, 1.0, "X", "2024"), ("A", 2, "MEDIAN", 15, 19, 1.0, "UN_WPP", "2024")]
    tables.replace_slices(schemas.FERTILITY, path, fertility(spark, old), ["iso3", "year"], t0())
    tables.replace_slices(schemas.FERTILITY, path, fertility(spark, [("A", 1, "MEDIAN", 15, 19, 2.0, "UN_WPP", "2024")]), ["iso3", "year"], t1())
    got = rows(source.read(spark, schemas.FERTILITY, path), "iso3", "year", "asfr", "release", "created_at")
    assert got == [("A", 1, 2.0, "2024", dt.datetime(2024, 2, 1)), ("A", 2, 1.0, "2024", dt.datetime(2024, 1, 1))]
    kept, other = ({os.path.basename(f) for f in glob.glob(f"{path}/year={y}/*.parquet")} for y in (2, 1))
    tables.replace_slices(schemas.FERTILITY, path, fertility(spark, [("B", 1, "MEDIAN", 15, 19, 3.0, "UN_WPP", "2024")]), ["iso3", "year"], t1())
    assert {os.path.basename(f) for f in glob.glob(f"{path}/year=2/*.parquet")} == kept
    assert {os.path.basename(f) for f in glob.glob(f"{path}/year=1/*.parquet")} != other
    assert rows(source.read(spark, schemas.FERTILITY, path), "iso3", "year", "asfr") == [("A", 1, 2.0), ("A", 2, 1.0), ("B", 1, 3.0)]


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "wb")
    one = wb(spark, [("A", "i", "n", 2000, 1.0, 0)])
    with fs.only_writer(spark, path):
        with pytest.raises(RuntimeError, match="another writer"):
            tables.upsert(schemas.WORLDBANK, path, one, t0(), ["_o"])
    with pytest.raises(Exception):
        tables.upsert(schemas.WORLDBANK, path, one.withColumn("year", F.raise_error(F.lit("x")).cast("int")), t0(), ["_o"])
    tables.upsert(schemas.WORLDBANK, path, one, t0(), ["_o"])  # a load that failed leaves no mark
    assert source.read(spark, schemas.WORLDBANK, path).count() == 1
    assert [n for n in os.listdir(tmp_path) if n.startswith("_")] == []


def test_load_metrics_are_observed(spark, tmp_path):
    rows_in = wb(spark, [("A", "i", "n", 2000, 1.0, 0), ("A", "i", "n", 2000, 2.0, 1), ("B", "i", "n", 2001, 3.0, 0), (None, "i", "n", 2001, 3.0, 0)])
    assert tables.upsert(schemas.WORLDBANK, str(tmp_path / "wb"), rows_in.repartition(3), t0(), ["_o"], "iso3") == tables.LoadMetrics(4, 3, 2)
    assert tables.upsert(schemas.WORLDBANK, str(tmp_path / "none"), rows_in.limit(0), t0(), ["_o"], "iso3") == tables.LoadMetrics(0, 0, 0)
    assert tables.upsert(schemas.WORLDBANK, str(tmp_path / "plain"), rows_in.limit(0), t0(), ["_o"]).entities is None


def test_files_in_order(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b")).repartition(6)
    ordered.write_ordered(df, path, ["a", "b"], files=5)
    got = [r.a for r in ordered.read_ordered(spark, path).orderBy("_place").collect()]
    assert got == sorted(got) and len(got) == 1000 and len(fs.data_files(spark, path)) > 1


def test_scan_below_a_root(spark, tmp_path):
    (tmp_path / "old").mkdir()
    for name, text in (("fra_pop_2020_x_COG.TIF", "a"), ("deu_pop_2020_x_cog.tiff", "bb"), ("fra_pop_2021_x_cog.tif", "c"), ("old/ita_pop_2020_x_cog.tif", "d"), ("fra_pop_2020_x_cog.tif.partial", "e")):
        (tmp_path / name).write_text(text)
    for root in (str(tmp_path), str(tmp_path) + "/", f"file:{tmp_path}"):
        found = listing.year_cogs(listing.list_files(spark, root, recursive=True), 2020, root)
        assert [os.path.basename(r.path) for r in found.collect()] == ["deu_pop_2020_x_cog.tiff", "fra_pop_2020_x_COG.TIF"]
    everywhere = listing.year_cogs(listing.list_files(spark, str(tmp_path), recursive=True), 2020)
    assert everywhere.count() == 3 and "content" not in everywhere.columns


def test_migrate_old_schema(spark, tmp_path):
    path = str(tmp_path / "asfr")
    fertility(spark, [("A", 1, "x", 15, 19, 1.0, "s", "r")]).drop("variant_short_name").write.parquet(path)
    for _ in range(2):
        tables.migrate(spark, schemas.FERTILITY, path, {"variant_short_name": "MEDIAN"})
        assert rows(source.read(spark, schemas.FERTILITY, path), "variant_short_name", "age_min") == [("MEDIAN", 15)]


def test_insert_if_absent_on_disk(spark, tmp_path):
    path = str(tmp_path / "r")
    ddl = "id bigint, stage string, filename string, run_id string, sha256 string, size_bytes bigint, content_type string, lo_oid bigint, created_at timestamp, exact_total double"
    one = spark.createDataFrame([(1, "raw", "f", "r", "x", 1, "t", 1, None, None)], ddl)
    two = spark.createDataFrame([(2, "raw", "f", "r", "x", 1, "t", 2, None, None), (3, "raw", "f", "r", "y", 1, "t", 3, None, None)], ddl)
    tables.insert_if_absent(schemas.RASTERS, path, one)
    tables.insert_if_absent(schemas.RASTERS, path, two)
    assert rows(source.read(spark, schemas.RASTERS, path), "id") == [(1,), (3,)]


def test_interrupted_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    fs.rename(spark, path, str(tmp_path / "_previous_t"))
    assert not fs.exists(spark, path)
    fs.recover(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_recompress(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    spark.range(20000).select("id", (F.col("id") % 7).cast("float").alias("v")).write.option("compression", "none").parquet(path)
    before = fs.size(spark, path)
    status, b, a = rewrite.recompress(spark, path, dry_run=True)
    assert status == "would-shrink" and (b, a < b) == (before, True) and fs.size(spark, path) == before
    with monkeypatch.context() as m:
        seen = iter([(1, "x"), (1, "y")])
        m.setattr(rewrite, "_digest", lambda df: next(seen))
        assert rewrite.recompress(spark, path) == ("CORRUPT", before, before)
    assert fs.size(spark, path) == before
    status, b, a = rewrite.recompress(spark, path)
    assert status == "ok" and a < b
    assert rewrite.recompress(spark, path)[0] == "skip"
    df = spark.read.parquet(path)
    assert df.count() == 20000 and df.agg(F.sum("id")).first()[0] == 20000 * 19999 // 2
    assert [n for n in os.listdir(tmp_path) if n.startswith("_")] == []
    for i in range(10):
        spark.range(i, 500).write.option("compression", "none").parquet(str(tmp_path / f"many{i}"))
    done = rewrite.recompress_all(spark, [path, *(str(tmp_path / f"many{i}") for i in range(10))])
    assert rows(done, "status") == [("ok",)] * 10 + [("skip",)]
    assert [spark.read.parquet(str(tmp_path / f"many{i}")).count() for i in range(10)] == [500 - i for i in range(10)]


def test_pyramid_csv(spark, tmp_path):
    from vitalgrid.operators import agebands

    totals = spark.createDataFrame([("FRA", 2020, "00", 1.5), ("FRA", 2020, "90", 2.0), ("DEU", 2020, "05", 3.0)], "iso3 string, year int, age_code string, total double")
    path = str(tmp_path / "csv")
    out_csv.write_pyramids(agebands.rebin(totals, ["iso3", "year"]), path)
    files = glob.glob(path + "/iso3=fra/year=2020/*.csv")
    assert len(files) == 1
    text = open(files[0]).read().splitlines()
    assert text[:3] == ["age_group,pop", "0-4,1.5", "5-9,0.0"] and text[-1] == "80+,2.0" and len(text) == 18


def test_stream_of_landed_rows(spark, tmp_path):
    land, path = str(tmp_path / "land"), str(tmp_path / "wb")
    rows_in = wb(spark, [("A", "i", "n", 2000, 1.0, 0)])
    rows_in.write.parquet(land)

    def drain():
        stream = landed.landed(spark, land, rows_in.schema)
        q = landed.upsert_stream(stream, schemas.WORLDBANK, path, lambda b: b, t0(), ["_o"], str(tmp_path / "cp"))
        q.awaitTermination(120)
        assert q.exception() is None

    drain()
    wb(spark, [("A", "i", "n", 2000, 2.0, 1), ("B", "i", "n", 2001, 3.0, 0)]).write.mode("append").parquet(land)
    drain()
    drain()
    assert rows(source.read(spark, schemas.WORLDBANK, path), "iso3", "year", "value") == [("A", 2000, 2.0), ("B", 2001, 3.0)]


def test_filter_and_projection_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "a")
    source.empty(spark, schemas.AIRPORTS).write.parquet(path)
    df = source.lookup(source.where_equal(source.read(spark, schemas.AIRPORTS, path), iso3="FRA"), "icao_code", "iso3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(iso3,FRA)" in plan and "ReadSchema: struct<icao_code:string,iso3:string>" in plan


def test_checkpoint_dir_is_taken_from_the_session():
    from types import SimpleNamespace

    from vitalgrid.session import checkpoint_dir

    def session(named, current=None, master="local[2]"):
        state = {"dir": current}
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: state["dir"], setCheckpointDir=lambda d: state.update(dir=d))
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named or default))

    assert checkpoint_dir(session("hdfs://shared/cp")) == "hdfs://shared/cp"
    assert checkpoint_dir(session("hdfs://shared/cp", "hdfs://set")) == "hdfs://set"
    assert checkpoint_dir(session(None)).startswith("/tmp/run-")
    with pytest.raises(ValueError):
        checkpoint_dir(session(None, master="spark://host:7077"))
