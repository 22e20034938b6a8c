import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import index as ix
from tessera.operators.pyramid import build_pyramid, pyramid_frame, read_pyramid, read_pyramid_attributes
from tessera.operators.validate import validate_pyramid
from tessera.sources import fixtures as fx
from tessera.sources.geoparquet import geo_footer, qualified, read_geoparquet, write_geoparquet
from tessera.sources.readers import read_index
from tessera.sources.writers import read_metadata, write_index, write_partials, write_pyramid


def test_index_write_read_back_sorted(spark, tmpdir_path):
    idx = ix.build_index(fx.footprints(spark, SF_SMALL))
    out = f"{tmpdir_path}/index"
    write_index(idx, out)
    back = read_index(spark, out)
    assert back.count() == idx.count()
    assert sorted(back.columns) == sorted(idx.columns)
    files = [os.path.join(r, f) for r, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    for f in files:
        ids = pq.read_table(f, columns=["h3_index"]).column(0).to_pylist()
        assert ids == sorted(ids)
    # partition pruning + pushed id range on the sorted index
    plan = back.where("h3_res = 5 AND h3_index BETWEEN 1 AND 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "h3_index" in plan


def test_partials_rewrite_of_a_run_is_idempotent(spark, tmpdir_path):
    part = ix.partials(fx.footprints(spark, SF_SMALL), [3, 5], tile_col="tile_id")
    out = f"{tmpdir_path}/partials"
    for run in ("a", "b", "a"):
        write_partials(part, out, run)
    back = spark.read.parquet(out)
    assert back.where("run = 'a'").count() == back.where("run = 'b'").count() == part.count()


def test_a_resumed_pyramid_reads_no_geometry_to_know_its_source(spark, tmpdir_path):
    from tessera.operators.pyramid import _work
    from tessera.sources.readers import scanned_files

    root, work = f"{tmpdir_path}/tiles", f"{tmpdir_path}/work"
    fx.buildings(spark, SF_SMALL).drop("tile_id", "half").repartition(3, "id").write.parquet(root)
    scan = spark.read.parquet(root)
    plan = scanned_files(scan)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "geometry" not in plan
    assert scanned_files(scan.select("id", "geometry")).agg(F.sum("rows")).first()[0] == scan.count()
    # changed rows are no plain scan: their content is hashed
    for other in (scan.where("height > 3"), scan.withColumn("geometry", F.reverse("geometry")), scan.select(F.upper("id").alias("id"), "geometry"), fx.footprints(spark, SF_SMALL)):
        assert scanned_files(other) is None
    first = sorted(pyramid_frame(scan, 2, 6, workdir=work).select("zoomlevel", "id").collect())
    folders = sorted(os.listdir(work))
    stamps = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{work}/**/*.parquet", recursive=True)}
    assert len(folders) == 1 and "files-" in folders[0]
    again = spark.read.parquet(root)
    assert sorted(pyramid_frame(again, 2, 6, workdir=work).select("zoomlevel", "id").collect()) == first
    assert {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{work}/**/*.parquet", recursive=True)} == stamps
    # a file that comes is another source
    scan.limit(5).withColumn("id", F.concat(F.lit("new-"), "id")).write.mode("append").parquet(root)
    more = spark.read.parquet(root)
    assert _work(more, ["id"], "geometry", work) != _work(scan, ["id"], "geometry", work)
    assert pyramid_frame(more, 2, 6, workdir=work).count() == len(first) + 5


def test_index_of_other_resolutions_stays(spark, tmpdir_path):
    idx = ix.build_index(fx.footprints(spark, SF_SMALL), [3, 5])
    out = f"{tmpdir_path}/index"
    for res in (3, 5, 3):
        write_index(idx.where(f"h3_res = {res}"), out)
    assert read_index(spark, out).count() == idx.count()


def test_pyramid_write_validate_metadata(spark, tmpdir_path):
    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    out = f"{tmpdir_path}/pyramid"
    meta = build_pyramid(b, out, 2, 10, key="id", workdir=f"{tmpdir_path}/work")
    p, scan = read_pyramid(spark, out), read_pyramid_attributes(spark, out)
    assert meta["rows_written"] == b.count() == p.count() == scan.count()
    checks = validate_pyramid(p, b.count(), 10, scan).collect()
    assert all(r["ok"] for r in checks) and {"total_rows", "zoom_10_rows", "unsorted_rows", "unknown_zoom_rows"} <= {r["check_name"] for r in checks}
    m = json.loads(json.dumps(read_metadata(spark, f"{out}/_metadata.json")))
    assert m["maxzoom"] == 10 and set(m["columns"]) == {*p.columns}
    assert p.where("length(quadkey) <> 10").count() == 0
    assert read_pyramid(spark, out, zoom=5).count() == p.where("zoomlevel = 5").count() > 0
    for z in (2, 5, 10):
        f = [os.path.join(r, x) for r, _, fs in os.walk(f"{out}/zoomlevel={z}") for x in fs if x.endswith(".parquet")]
        for path in f:
            q = pq.read_table(path, columns=["quadkey"]).column(0).to_pylist()
            assert q == sorted(q)
    # a second build replaces the first one whole
    build_pyramid(b.where("source < 'N'"), out, 2, 10, key="id")
    assert read_pyramid(spark, out).count() == b.where("source < 'N'").count()


def test_broken_pyramids_fail_their_checks(spark, tmpdir_path):
    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    p = pyramid_frame(b, 2, 8, key="id").cache()
    n = p.count()
    bad = lambda df, scan=None: {r["check_name"] for r in validate_pyramid(df, n, 8, scan).collect() if not r["ok"]}
    assert bad(p) == set()
    assert bad(p.where("zoomlevel <> 3")) == {"total_rows"}
    assert bad(p.unionByName(p.where("zoomlevel = 3"))) == {"total_rows", "zoom_3_rows"}
    assert "zoom_2_rows" in bad(p.withColumn("zoomlevel", F.lit(2)))
    assert bad(p.withColumn("zoomlevel", F.when(F.col("zoomlevel") < 8, F.col("zoomlevel")))) == {"unknown_zoom_rows"}
    out = f"{tmpdir_path}/unsorted"
    p.drop("geometry").coalesce(1).orderBy(F.desc("quadkey")).write.parquet(out)
    assert bad(p, spark.read.parquet(out)) == {"unsorted_rows"}


def test_repeated_ids_keep_their_rows(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    b = fx.buildings(spark, SF_SMALL).drop("half", "tile_id").withColumn("id", F.substring("id", 1, 2))
    b.repartition(5).write.parquet(src)
    scan = spark.read.parquet(src)
    p = pyramid_frame(scan, 2, 8)
    assert p.count() == scan.count()
    out = f"{tmpdir_path}/out"
    assert build_pyramid(scan, out, 2, 8)["rows_written"] == scan.count()
    import pytest

    with pytest.raises(ValueError):
        build_pyramid(scan, out, 2, 8, key="id")


def test_plain_parquet_pyramid(spark, tmpdir_path):
    p = pyramid_frame(fx.buildings(spark, SF_SMALL).drop("tile_id", "half"), 2, 8, key="id")
    out = f"{tmpdir_path}/plain"
    assert write_pyramid(p, out) == spark.read.parquet(out).count() == p.count()


def test_geoparquet_sink_and_footer(spark, tmpdir_path):
    import duckdb

    b = fx.buildings(spark, SF_SMALL).drop("tile_id").withColumnRenamed("half", "zoomlevel")
    out = f"{tmpdir_path}/geo"
    write_geoparquet(b.repartition(2).sortWithinPartitions("zoomlevel", "id"), out, partition_by="zoomlevel")
    types = dict((r[0], r[1]) for r in duckdb.sql(
        f"describe select * from read_parquet('{out}/**/*.parquet', hive_partitioning=true)").fetchall())
    assert types["geometry"] == "GEOMETRY"
    n = duckdb.sql(f"select count(*) from read_parquet('{out}/**/*.parquet')").fetchall()[0][0]
    assert n == b.count()
    f = geo_footer(spark, out).collect()
    assert f and all(r["version"] == "1.1.0" and r["encoding"] == "WKB" and r["primary_column"] == "geometry" for r in f)
    assert all(r["crs"] == "EPSG:4326" for r in f)


def test_row_groups_are_full(spark, tmpdir_path):
    b = fx.buildings(spark, "/root/testdata/sf0.01").drop("tile_id", "half").coalesce(1)
    out = f"{tmpdir_path}/groups"
    assert write_geoparquet(b, out, row_group_size=25_000) == b.count()
    (r,) = geo_footer(spark, out).collect()
    assert r["largest_group"] == 25_000 and r["num_rows"] == b.count()


def test_geoparquet_read_back(spark, tmpdir_path):
    from tessera.functions.measures import with_measures

    b = fx.buildings(spark, SF_SMALL).drop("tile_id").withColumnRenamed("half", "zoomlevel")
    out = f"{tmpdir_path}/geo2"
    write_geoparquet(b.repartition(3), out, partition_by="zoomlevel")
    back = read_geoparquet(spark, out)
    assert dict(back.dtypes)["geometry"] == "binary" and dict(back.dtypes)["zoomlevel"] == "int"
    assert back.count() == b.count()
    got = sorted(map(tuple, with_measures(back).select("id", "zoomlevel", "lon", "lat").collect()))
    exp = sorted(map(tuple, with_measures(b).select("id", "zoomlevel", "lon", "lat").collect()))
    assert got == exp


def test_index_v1_geoparquet(spark, tmpdir_path):
    import duckdb

    from tessera.sources.geoparquet import write_index_v1

    idx = ix.build_index(fx.footprints(spark, SF_SMALL), [3, 5])
    out = f"{tmpdir_path}/v1"
    write_index_v1(idx, out)
    types = dict((r[0], r[1]) for r in duckdb.sql(
        f"describe select * from read_parquet('{out}/**/*.parquet', hive_partitioning=true)").fetchall())
    assert types["geometry"] == "GEOMETRY" and types["h3_index"] == "VARCHAR" and types["lat"] == "FLOAT"
    back = read_geoparquet(spark, out)
    assert back.count() == idx.count()
    assert {r[0] for r in back.select("h3_res").distinct().collect()} == {3, 5}


def test_a_commit_that_dies_leaves_one_whole_output(spark, tmpdir_path):
    import pyarrow as pa

    from tessera.sources.geoparquet import GeoParquetWriter, _list_parquet, geo_footer, read_geoparquet, write_geoparquet

    path = f"{tmpdir_path}/out"
    old = spark.range(20).selectExpr("id", "id % 3 AS k", "unhex('0101') AS geometry")
    assert write_geoparquet(old, path, partition_by="k") == 20
    ids = lambda p=path: sorted(r["id"] for r in read_geoparquet(spark, p).select("id").collect())
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(100, 130), pa.int64()), "k": pa.array([1] * 30, pa.int64()), "geometry": pa.array([b"\x01"] * 30)})
    writer = GeoParquetWriter({"path": path, "partition_by": "k"}, True)
    done, lost = writer.write(iter([batch])), GeoParquetWriter({"path": path, "partition_by": "k"}, True).write(iter([batch]))
    assert lost.files != done.files
    # dies before the manifest: the old output, files of the new one beside it
    assert ids() == list(range(20)) and ids(f"{path}/k=1") == list(range(1, 20, 3))
    assert geo_footer(spark, path).agg({"num_rows": "sum"}).first()[0] == 20

    # dies after the manifest: the new output, files of the old one beside it
    def dies(*_):
        raise RuntimeError("lost")

    writer.clear = dies
    with pytest.raises(RuntimeError):
        writer.commit([done, None])
    assert ids() == list(range(100, 130)) and geo_footer(spark, path).agg({"num_rows": "sum"}).first()[0] == 30
    assert ids(f"{path}/k=1") == list(range(100, 130))
    # an aborted run takes its own files along only
    GeoParquetWriter({"path": path, "partition_by": "k", "job_id": "gone"}, True).abort([])
    assert ids() == list(range(100, 130))
    # the next run clears what is left over
    assert write_geoparquet(old.limit(5), path, partition_by="k") == 5
    assert ids() == list(range(5))
    there = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert sorted(there) == _list_parquet(path)


def test_a_task_goes_on_in_another_file(spark, tmpdir_path):
    from tessera.sources.geoparquet import read_geoparquet, write_geoparquet

    df = spark.range(0, 25, 1, 1).selectExpr("id", "id % 2 AS k", "unhex('0101') AS geometry")
    assert write_geoparquet(df, f"{tmpdir_path}/out", partition_by="k", max_rows_per_file=5) == 25
    files = {f: pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmpdir_path}/out/k=*/*.parquet")}
    assert sorted(files.values()) == [2, 3, 5, 5, 5, 5]
    assert sorted(r["id"] for r in read_geoparquet(spark, f"{tmpdir_path}/out").collect()) == list(range(25))


def test_shared_folders_of_a_cluster_are_taken(spark, tmpdir_path, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert qualified(spark, f"{root}/pyramid-1").endswith("/pyramid-1")
    assert qualified(spark, f"file://{root}/pyramid-1").startswith("file:")
    for alone in (f"{tmpdir_path}/pyramid", f"{root}-other/pyramid", f"{root}/../pyramid"):
        with pytest.raises(ValueError, match="one machine"):
            qualified(spark, alone)


def test_a_pyramid_is_read_once_for_its_checks(spark, tmpdir_path):
    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    out = f"{tmpdir_path}/b"
    b.withColumn("zoomlevel", F.lit(3)).write.parquet(out)
    plan = validate_pyramid(spark.read.parquet(out), 1, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    checks = {r["check_name"]: (r["value"], r["ok"]) for r in validate_pyramid(spark.read.parquet(out).limit(0), 0, 8).collect()}
    assert checks == {"total_rows": (0, True), "unknown_zoom_rows": (0, True)}


def test_quadkeys_travel_as_numbers(spark, tmpdir_path):
    from tessera.operators.pyramid import zoomed_keys

    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    z = zoomed_keys(b, 2, 8, "id", "geometry", tmpdir_path)
    assert dict(z.dtypes) == {"id": "string", "__quadkey_code": "bigint", "zoomlevel": "int"}
    assert spark.read.parquet(f"{tmpdir_path}/measured-8").dtypes[-1] == ("__quadkey_code", "bigint")


def test_a_pyramid_by_a_path_that_hadoop_alone_knows(spark, tmpdir_path):
    """The checkpoint folder may be a mount of ``viewfs``: tasks get the path behind it."""
    os.makedirs(f"{tmpdir_path}/behind")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tessera.link./kept", f"file://{tmpdir_path}/behind")
    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    out = "viewfs://tessera/kept/pyramid"
    n = build_pyramid(b, out, 2, 8, key="id")["rows_written"]
    assert n == b.count() == read_pyramid(spark, out).count() == read_pyramid_attributes(spark, out).count()
    assert read_metadata(spark, f"{out}/_metadata.json")["rows_written"] == n
    assert geo_footer(spark, out).agg(F.sum("num_rows")).first()[0] == n
    assert read_pyramid(spark, out, zoom=5).count() == read_pyramid(spark, out).where("zoomlevel = 5").count() > 0
    assert qualified(spark, out) == f"file:{tmpdir_path}/behind/pyramid"


def _quarter(spark):
    """Buildings, some without a geometry."""
    b = fx.buildings(spark, SF_SMALL).drop("tile_id", "half")
    return b.withColumn("geometry", F.expr("CASE WHEN source = 'AF' THEN NULL ELSE geometry END"))


@pytest.mark.parametrize("range_rows", [400, 2_000_000])
def test_ranges_of_a_pyramid_give_the_rows_of_the_whole(spark, tmpdir_path, monkeypatch, range_rows):
    from tessera.operators import pyramid as py

    monkeypatch.setattr(py, "RANGE_ROWS", range_rows)
    src, out = _quarter(spark), f"{tmpdir_path}/pyramid"
    frame, rows = py._laid_out(src, 2, 9, ["id"], "geometry", f"{tmpdir_path}/work")
    assert rows == len(frame.collect())
    # both halves read one shuffle of the geometry
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()
    assert build_pyramid(src, out, 2, 9, key="id")["rows_written"] == rows
    columns = ["zoomlevel", "quadkey", "id", "geometry"]
    want = pyramid_frame(src, 2, 9, key="id").select(*columns)
    got = read_pyramid(spark, out).select(*columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    files = read_pyramid_attributes(spark, out).groupBy("zoomlevel", F.input_file_name().alias("f")).agg(F.min("quadkey").alias("low"), F.max("quadkey").alias("high"))
    by_zoom = {}
    for r in files.where("low IS NOT NULL").orderBy("zoomlevel", "low", "high").collect():
        assert by_zoom.get(r["zoomlevel"], "") <= r["low"]
        by_zoom[r["zoomlevel"]] = r["high"]
    n = files.where("zoomlevel = 9").count()
    assert n > 5 if range_rows == 400 else n == 1


def test_small_files_take_no_task_each(spark, tmpdir_path):
    src, out = fx.buildings(spark, SF_SMALL).drop("tile_id", "half"), f"{tmpdir_path}/pyramid"
    build_pyramid(src, out, key="id", max_file_rows=50)
    files = [os.path.basename(f) for f in glob.glob(f"{out}/**/*.parquet", recursive=True)]
    assert len(files) >= 100 and len({f.split("-")[1] for f in files}) < 10


def test_a_null_key_raises_before_anything_is_written(spark, tmpdir_path):
    src, out = _quarter(spark), f"{tmpdir_path}/pyramid"
    src = src.withColumn("id", F.expr("CASE WHEN height > 14 THEN NULL ELSE id END"))
    with pytest.raises(ValueError, match="key repeats or is null"):
        build_pyramid(src, out, 2, 6, key="id")
    assert not os.path.exists(out)


def test_rows_out_of_order_are_counted_over_batches_and_splits(spark, tmpdir_path):
    from tessera.operators.validate import unsorted_rows

    rows = spark.range(0, 30_000, 1, 1).selectExpr(
        "CAST(id / 10000 AS INT) AS zoomlevel",
        "CASE WHEN id IN (5, 10000, 20001) THEN NULL WHEN id IN (9999, 15000) THEN '000' ELSE lpad(id, 9, '0') END AS quadkey",
    )
    rows.write.option("parquet.block.row.count.limit", 4_000).parquet(f"{tmpdir_path}/rows")
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            scan = spark.read.parquet(f"{tmpdir_path}/rows")
            assert unsorted_rows(scan).first()["n"] == 4
            assert unsorted_rows(scan.where("false")).first()["n"] == 0
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plan = unsorted_rows(scan)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange hashpartitioning(file_path")
