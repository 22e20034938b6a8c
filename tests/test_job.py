import time

from conftest import SF_SMALL
from tessera.operators import index as ix
from tessera.plans.index_job import read_ledger, run_index_job
from tessera.sources import fixtures as fx
from tessera.sources.readers import dry_run, list_tiles, read_footprints, read_index, tile_status


def _write_tiles(spark, root, where=None):
    b = fx.buildings(spark, SF_SMALL).drop("half")
    if where:
        b = b.where(where)
    b.repartition("tile_id").write.mode("append").partitionBy("tile_id").parquet(root)
    return b


def _close(a, b):
    a, b = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3]
        for u, v in zip(x[3:], y[3:]):
            assert (u is None and v is None) or abs(u - v) <= 1e-5 * max(1.0, abs(u))


def test_incremental_job_with_ledger(spark, tmpdir_path):
    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    _write_tiles(spark, src, "lon < 0")
    m1 = run_index_job(spark, src, work, out, resolutions=[3, 5])
    assert m1["tiles_processed"] > 0
    m2 = run_index_job(spark, src, work, out, resolutions=[3, 5])
    assert m2["tiles_processed"] == 0  # nothing new: ledger skips everything
    _write_tiles(spark, src, "lon >= 0")  # new tiles arrive
    m3 = run_index_job(spark, src, work, out, resolutions=[3, 5])
    assert m3["tiles_processed"] > 0
    m4 = run_index_job(spark, src, work, out, resolutions=[3, 5, 8])  # new resolution: all tiles again, res 8 only
    led = read_ledger(spark, f"{work}/ledger")
    assert led.where("h3_res = 8").count() == list_tiles(spark, src).count()
    run_index_job(spark, src, work, out, resolutions=[8])  # a run of one resolution leaves the others
    got = read_index(spark, out)
    direct = ix.build_index(fx.footprints(spark, SF_SMALL), [3, 5, 8])
    _close(got.select(*direct.columns), direct)
    assert set(m4["cells_per_resolution"]) == {"3", "5", "8"}


def test_late_and_changed_files_of_a_done_tile(spark, tmpdir_path):
    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    b = fx.buildings(spark, SF_SMALL).drop("half")
    for where in ("CAST(height AS INT) % 2 = 0", "CAST(height AS INT) % 2 <> 0"):
        b.where(where).repartition("tile_id").write.mode("append").partitionBy("tile_id").parquet(src)
        run_index_job(spark, src, work, out, resolutions=[5])
    direct = ix.build_index(fx.footprints(spark, SF_SMALL), [5])
    _close(read_index(spark, out).select(*direct.columns), direct)
    time.sleep(1.1)
    b.limit(100).repartition("tile_id").write.mode("overwrite").partitionBy("tile_id").parquet(f"{src}/more")
    n = run_index_job(spark, src, work, out, resolutions=[5])["tiles_processed"]
    assert n > 0 and read_index(spark, out).agg({"building_count": "sum"}).first()[0] == b.count() + 100


def test_a_source_of_empty_tiles_gives_an_empty_index(spark, tmpdir_path):
    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    fx.buildings(spark, SF_SMALL).drop("half", "tile_id").limit(0).coalesce(1).write.parquet(f"{src}/tile_id=none")
    meta = run_index_job(spark, src, work, out, resolutions=[5])
    assert meta["tiles_processed"] == 1 and meta["cells_per_resolution"] == {}
    assert [r["status"] for r in read_ledger(spark, f"{work}/ledger").collect()] == ["skipped_empty"]


def test_tile_listing_and_status(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    b = _write_tiles(spark, src)
    t = list_tiles(spark, src)
    assert t.select("tile_id").distinct().count() == b.select("tile_id").distinct().count()
    assert dry_run(spark, src, 10).count() == 10
    df = read_footprints(spark, src, ["geometry", "height"])
    st = tile_status(t, df)
    assert st.where("status = 'done'").count() == t.count()


def test_row_identity_and_file_counts(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from tessera.operators.profile import file_row_counts
    from tessera.sources.readers import with_row_identity

    src = f"{tmpdir_path}/src"
    b = _write_tiles(spark, src)
    df = with_row_identity(spark.read.option("recursiveFileLookup", "true").parquet(src))
    assert df.select("file_path", "row_index").distinct().count() == b.count()
    counts = file_row_counts(spark.read.option("recursiveFileLookup", "true").parquet(src))
    assert counts.agg(F.sum("row_count")).collect()[0][0] == b.count()


def test_population_partition_pruning(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from tessera.sources.readers import read_population

    root = f"{tmpdir_path}/pop"
    rows = [(i, float(i), s, r) for i in range(10) for s in ("SSP1", "SSP2") for r in (4, 5)]
    spark.createDataFrame(rows, "h3_index long, pop_2025 double, scenario string, h3_res int").write.partitionBy(
        "scenario", "h3_res"
    ).parquet(root)
    p = read_population(spark, root, "SSP2", 5)
    assert p.count() == 10
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "SSP2" in plan
    assert p.agg(F.sum("pop_2025")).collect()[0][0] == 45.0


def test_empty_tile_and_bad_geometry(spark, tmpdir_path):
    import pytest

    from tessera.plans.index_job import read_ledger

    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    b = fx.buildings(spark, SF_SMALL).drop("half")
    one = b.where("tile_id = '-35_-11'")
    one.write.partitionBy("tile_id").parquet(src)
    schema = b.drop("tile_id").schema
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{src}/tile_id=empty")
    bad = spark.createDataFrame([("bad", "x", "y", 5.0, 0.0, bytearray(b"\x01\x03\x00"))], schema)
    bad.coalesce(1).write.parquet(f"{src}/tile_id=broken")
    with pytest.raises(ValueError):
        run_index_job(spark, src, f"{tmpdir_path}/strict", out, resolutions=[5], strict=True)
    run_index_job(spark, src, work, out, resolutions=[5])
    led = {r["tile_id"]: r for r in read_ledger(spark, f"{work}/ledger").collect()}
    assert led["empty"]["status"] == "skipped_empty"
    assert led["broken"]["status"] == "done" and led["broken"]["rejected"] == 1
    got = read_index(spark, out).agg({"building_count": "sum"}).collect()[0][0]
    assert got == one.count()


def _direct(spark, where, resolutions=(5,)):
    return ix.build_index(fx.footprints(spark, SF_SMALL).where(where), list(resolutions))


def _write_to(spark, path, where):
    fx.buildings(spark, SF_SMALL).drop("half").where(where).repartitionByRange("tile_id", "id").write.mode("append").partitionBy("tile_id").parquet(path)


def test_an_append_only_source_keeps_files_that_leave(spark, tmpdir_path):
    import shutil

    import pytest

    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    _write_to(spark, f"{src}/a", "half = 0")
    _write_to(spark, f"{src}/b", "half = 1")
    run_index_job(spark, src, work, out, resolutions=[5], append_only=True)
    shutil.move(f"{src}/b", f"{tmpdir_path}/away")
    assert run_index_job(spark, src, work, out, resolutions=[5], append_only=True)["tiles_withdrawn"] == 0
    _close(read_index(spark, out).select("h3_res", *_direct(spark, "true").columns[1:]), _direct(spark, "true"))
    meta = run_index_job(spark, src, work, out, resolutions=[5])
    assert meta["tiles_withdrawn"] > 0
    _close(read_index(spark, out).select("h3_res", *_direct(spark, "true").columns[1:]), _direct(spark, "half = 0"))
    shutil.move(f"{tmpdir_path}/away", f"{src}/b")  # the same versions come back
    run_index_job(spark, src, work, out, resolutions=[5])
    _close(read_index(spark, out).select("h3_res", *_direct(spark, "true").columns[1:]), _direct(spark, "true"))
    shutil.move(src, f"{tmpdir_path}/all")
    import os

    os.mkdir(src)
    with pytest.raises(ValueError, match="no files"):
        run_index_job(spark, src, work, out, resolutions=[5])
    run_index_job(spark, src, work, out, resolutions=[5], allow_empty=True)
    assert read_index(spark, out).count() == 0 if any(f.endswith(".parquet") for _, _, fs in os.walk(out) for f in fs) else True


def test_a_second_run_reads_and_writes_the_zones_it_touches_only(spark, tmpdir_path):
    from tessera.sources import levels as lv

    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    box = "lon > 100"
    _write_to(spark, src, f"NOT ({box})")
    run_index_job(spark, src, work, out, resolutions=[5])
    before = {r["zone"]: r["run"] for r in lv.read_catalog(spark, f"{work}/catalog", read_ledger(spark, f"{work}/ledger").select("seq", "run").distinct()).collect()}
    _write_to(spark, src, box)
    run_index_job(spark, src, work, out, resolutions=[5])
    ledger = read_ledger(spark, f"{work}/ledger")
    catalog = lv.read_catalog(spark, f"{work}/catalog", ledger.select("seq", "run").distinct())
    after = {r["zone"]: r["run"] for r in catalog.collect()}
    touched = sorted(z for z, run in after.items() if before.get(z) != run)
    assert 0 < len(touched) < len(after) / 3
    base = lv.read_base(spark, f"{work}/base", catalog, {5: touched})
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(h3_res,5)" in plan and ("In(zone" in plan or "EqualTo(zone" in plan) and str(touched[0]) in plan
    rows = spark.read.parquet(f"{work}/base").groupBy("run").count().collect()
    assert len(rows) == 2 and min(r["count"] for r in rows) < max(r["count"] for r in rows) / 2
    direct = _direct(spark, "true")
    _close(read_index(spark, out).select(*direct.columns), direct)


def test_a_run_that_dies_before_the_ledger_leaves_no_trace(spark, tmpdir_path, monkeypatch):
    import pytest

    from tessera.plans import index_job as ij
    from tessera.sources import levels as lv

    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    direct = _direct(spark, "true")
    _write_to(spark, src, "half = 0")
    run_index_job(spark, src, work, out, resolutions=[5])
    _write_to(spark, src, "half = 1")

    def die(*a, **k):
        raise RuntimeError("lost")

    append = lv.append_catalog
    for broken in ("append_catalog", "publish_zones", "after_catalog"):
        with monkeypatch.context() as m:
            if broken == "after_catalog":
                # the catalog names the run, the ledger does not
                m.setattr(lv, "append_catalog", lambda *a: (append(*a), die()))
            else:
                m.setattr(lv, broken, die)
            if broken != "publish_zones":
                with pytest.raises(RuntimeError):
                    run_index_job(spark, src, work, out, resolutions=[5])
                _close(read_index(spark, out).select(*direct.columns), _direct(spark, "half = 0"))
    with monkeypatch.context() as m:
        m.setattr(lv, "publish_zones", die)
        with pytest.raises(RuntimeError):
            run_index_job(spark, src, work, out, resolutions=[5])
    assert ij.run_index_job(spark, src, work, out, resolutions=[5])["tiles_processed"] == 0
    _close(read_index(spark, out).select(*direct.columns), direct)


def test_an_owner_that_leaves_hands_its_buildings_on(spark, tmpdir_path):
    import shutil

    import pytest

    src, work, out = f"{tmpdir_path}/src", f"{tmpdir_path}/work", f"{tmpdir_path}/out"
    _write_to(spark, f"{src}/b", "half = 0 OR lon < 0")
    run_index_job(spark, src, work, out, resolutions=[3, 5], dedup_by="id")
    _write_to(spark, f"{src}/a", "half = 1 OR lon < 0")
    _write_to(spark, f"{src}/c", "lat > 0")
    run_index_job(spark, src, work, out, resolutions=[3, 5], dedup_by="id")
    direct = _direct(spark, "true", (3, 5))
    _close(read_index(spark, out).select(*direct.columns), direct)
    shutil.move(f"{src}/a", f"{tmpdir_path}/away")
    run_index_job(spark, src, work, out, resolutions=[3, 5], dedup_by="id")
    _close(read_index(spark, out).select(*direct.columns), _direct(spark, "half = 0 OR lon < 0 OR lat > 0", (3, 5)))
    with pytest.raises(ValueError, match="made with"):
        run_index_job(spark, src, work, out, resolutions=[3, 5])


def test_pending_files_are_a_stored_list(spark, tmpdir_path):
    src, work = f"{tmpdir_path}/src", f"{tmpdir_path}/work"
    _write_tiles(spark, src)
    n = run_index_job(spark, src, work, f"{tmpdir_path}/out", resolutions=[3])["tiles_processed"]
    assert spark.read.parquet(f"{work}/stages/*/todo").count() == n > 0


def test_owners_are_found_in_one_shuffle(spark):
    from tessera.plans.index_job import _owned

    rows = [  # key, file_no, row_index, were, present
        ("stays", 1, 5, True, True), ("stays", 2, 0, True, True), ("earlier comes", 0, 9, False, True), ("earlier comes", 2, 1, True, True),
        ("owner leaves", 0, 0, True, False), ("owner leaves", 3, 2, True, True), ("leaves", 0, 1, True, False), ("comes", 4, 4, False, True),
        ("twice in a file", 4, 8, False, True), ("twice in a file", 4, 7, False, True),
    ]
    df = spark.createDataFrame(rows, "key string, file_no long, row_index long, were boolean, present boolean")
    owned = _owned(df.selectExpr("*", "1D AS lat", "2D AS lon", "3D AS fp_m2", "CAST(file_no AS DOUBLE) AS h"))
    got = {tuple(r) for r in owned.select("file_no", "row_index", "h", "moved", "old_file").collect()}
    assert got == {(1, 5, 1.0, False, None), (0, 9, 0.0, True, 2), (3, 2, 3.0, True, 0), (None, None, None, True, 0), (4, 4, 4.0, True, None), (4, 7, 4.0, True, None)}
    assert owned._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_tiles_in_ranges_are_the_same_buildings(spark):
    got, want = (fx.buildings(spark, SF_SMALL, by_tile=b).drop("half") for b in (True, False))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
