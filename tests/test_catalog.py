import hashlib

from pyspark.sql import functions as F

from conftest import rows
from vitalgrid import refdata
from vitalgrid.functions import files
from vitalgrid.operators import catalog
from vitalgrid.plans import rasters, runs
from vitalgrid.sources import listing, requests


def test_requests(spark):
    one = refdata.countries(spark, ["FRA"])
    got = requests.raster_requests(one).collect()
    assert len(got) == 12
    assert got[0].url == (
        "https://data.worldpop.org/GIS/Population/Global_2015_2030/R2025A/2015/FRA/v1/100m/constrained/"
        "fra_pop_2015_CN_100m_R2025A_v1.tif"
    )
    aged = requests.age_requests(one, (2020, 2020)).collect()
    assert len(aged) == 20 and aged[0].filename == "fra_t_00_2020_CN_100m_R2025A_v1.tif"


def test_worklist(spark):
    todo = requests.raster_requests(refdata.countries(spark, ["AAA"]), (2015, 2021))

    def raw(y):
        return f"aaa_pop_{y}_CN_100m_R2025A_v1.tif"

    def wm(y):
        return f"aaa_pop_{y}_CN_100m_R2025A_v1_3857.tif"

    def cog(y):
        return f"aaa_pop_{y}_CN_100m_R2025A_v1_cog.tif"

    files_ = [("/d/" + raw(y), 0 if y == 2016 else 10) for y in range(2016, 2022)]
    files_ += [("/d/" + wm(y), 0 if y == 2019 else 10) for y in range(2019, 2022)]
    stored = [("raw", raw(y), None if y == 2018 else 1.0) for y in range(2018, 2022)] + [("cog", cog(2021), None)]
    stored += [("cog", raw(2017), 1.0)]
    got = catalog.worklist(
        todo,
        spark.createDataFrame(files_, "path string, length bigint"),
        spark.createDataFrame(stored, "stage string, filename string, exact_total double"),
    )
    assert [r[1] for r in rows(got, "year", "next_step")] == [
        "download_raw", "download_raw", "store_raw", "rio_calc", "warp_web_mercator", "to_cog", "skip",
    ]


def test_manifest_diff(spark):
    local = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), ("e", 1)], "path string, local_size bigint")
    remote = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1), ("d", None)], "path string, remote_size bigint")
    got = dict(rows(catalog.manifest_diff(local, remote), "path", "action"))
    assert got == {"a": "keep", "b": "refetch", "c": "refetch", "d": "refetch", "e": "unlisted"}


def test_store_replaces_older_entries(spark):
    ddl = "id bigint, stage string, filename string, run_id string, sha256 string, size_bytes bigint, content_type string"
    old = spark.createDataFrame([(1, "raw", "a.tif", "r0", "x", 1, "t"), (2, "raw", "a.tif", "r0", "y", 1, "t"), (3, "cog", "a.tif", "r0", "z", 1, "t")], ddl)
    found = spark.createDataFrame([("/in/a.tif", 3, bytearray(b"abc"))], "path string, length bigint, content binary")
    got = rows(rasters.store(old, found, "raw", "r1"), "stage", "filename", "run_id", "sha256", "size_bytes", "content_type")
    assert got == [
        ("cog", "a.tif", "r0", "z", 1, "t"),
        ("raw", "a.tif", "r1", hashlib.sha256(b"abc").hexdigest(), 3, "image/tiff"),
    ]
    twice = spark.createDataFrame([("/in/a.tif", 3, bytearray(b"abc"), 1), ("/in/a.tif", 2, bytearray(b"de"), 2)], "path string, length bigint, content binary, o int")
    again = rasters.store(old, twice, "raw", "r2", order=["o"])
    assert [(r.id > 3, r.size_bytes) for r in catalog.newest(again).where("stage = 'raw'").collect()] == [(True, 2)]
    assert rows(catalog.newest(old), "stage", "id") == [("cog", 3), ("raw", 2)]


def test_blob_liveness(spark):
    cat = spark.createDataFrame([(1,), (2,)], "lo_oid bigint")
    blobs = spark.createDataFrame([(2,), (3,)], "lo_oid bigint")
    assert rows(catalog.live(cat, blobs)) == [(2,)]
    assert rows(catalog.stale(cat, blobs)) == [(1,)]
    assert rows(catalog.orphans(cat, blobs)) == [(3,)]


def test_listing(spark, tmp_path):
    for name in ("fra_pop_2020_x_cog.tif", "deu_POP_2020_x_COG.TIFF", "ita_pop_2021_x_cog.tif", "esp_pop_2020_cog.tif.partial", "fra_pop_2020_x.tif"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "prt_pop_2020_x_cog.tif").write_bytes(b"xx")
    (tmp_path / "sub" / "nil_pop_2020_x_cog.tif").write_bytes(b"")
    flat = listing.list_files(spark, str(tmp_path))
    found = [p.split("/")[-1] for (p,) in rows(listing.year_cogs(flat, 2020), "path")]
    assert found == ["deu_POP_2020_x_COG.TIFF", "fra_pop_2020_x_cog.tif"]
    deep = listing.list_files(spark, str(tmp_path), "*.tif", recursive=True)
    assert deep.count() == 4  # the empty file is left out
    assert rows(listing.excluding(deep, ["fra_*"]).select(files.base_name(F.col("path")))) == [("ita_pop_2021_x_cog.tif",), ("prt_pop_2020_x_cog.tif",)]
    sizes = spark.createDataFrame([(0,), (1,), (None,)], "n bigint")
    assert [r[0] for r in sizes.select(files.usable(F.col("n"))).collect()] == [False, True, False]
    with_bytes = listing.list_files(spark, str(tmp_path), "fra_pop_2020_x.tif", content=True)
    assert catalog.entries(with_bytes, "raw", "r").first().sha256 == hashlib.sha256(b"x").hexdigest()


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:01",)], "t string").select(F.col("t").cast("timestamp").alias("modificationTime"), F.lit("p").alias("path"))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert listing.stale(df, now).count() == 1


def test_rewrite_report(spark):
    df = spark.createDataFrame([("ok", 2048, 1024), ("skip", 10, 10), ("ok", 2048, 1024)], "status string, before bigint, after bigint")
    got = {r.status: r for r in catalog.rewrite_report(df).collect()}
    assert (got["ok"].files, got["ok"].saved, got["ok"].before_text, got["ok"].percent) == (2, 2048, "4.0 KiB", 50.0)
    assert (got["total"].files, got["total"].before, got["total"].after) == (3, 4106, 2058)


def test_runs(spark):
    df = spark.createDataFrame(
        [("a", "FRA", 2020, '{"beta":0.3}', 1), ("b", "FRA", 2020, "{", 2), ("c", "FRA", 2021, None, 1)],
        "id string, iso3 string, year int, params string, created_at int",
    )
    params = runs.with_params(df).select("id", F.try_variant_get("params", "$.beta", "double"))
    assert rows(params) == [("a", 0.3), ("b", None), ("c", None)]
    points = spark.createDataFrame([("a", 0.0), ("b", 0.0), ("z", 0.0)], "run_id string, t double")
    assert rows(runs.run_points(runs.newest_runs(df), points), "run_id", "year") == [("b", 2020)]
