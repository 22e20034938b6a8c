from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import index as ix
from tessera.operators import validate as va
from tessera.sources import fixtures as fx


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fixture_shape(spark):
    fp = fx.footprints(spark, "/root/testdata/sf0.01")
    assert fp.count() == 60000
    assert fp.select("id").distinct().count() == 60000
    assert fp.select("tile_id").distinct().count() == 112
    assert fp.where("height = -999").count() == 8740


def test_golden_cell_counts(spark):
    idx = ix.build_index(fx.footprints(spark, "/root/testdata/sf0.01"))
    got = {r["h3_res"]: r["n_cells"] for r in ix.cell_counts(idx).collect()}
    assert got == {3: 156, 4: 267, 5: 704, 6: 2667, 7: 13496, 8: 43045}
    no_h = {r["h3_res"]: r["c"] for r in idx.where("avg_height_m IS NULL").groupBy("h3_res").agg(F.count("*").alias("c")).collect()}
    assert no_h == {3: 15, 4: 30, 5: 70, 6: 270, 7: 1414, 8: 5689}


def test_partial_merge_equals_direct(spark):
    fp = fx.footprints(spark, SF_SMALL)
    direct = ix.build_index(fp)
    for split in ("half", "tile_id"):
        merged = ix.merge_partials(ix.partials(fp, tile_col=split))
        a, b = _rows(direct), _rows(merged)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x[:3] == y[:3]
            for u, v in zip(x[3:], y[3:]):
                assert (u is None and v is None) or abs(u - v) <= 1e-5 * max(1.0, abs(u))


def test_same_total_every_resolution(spark):
    idx = ix.build_index(fx.footprints(spark, SF_SMALL))
    rows = va.consistency(idx).collect()
    assert {r["max_diff"] for r in rows} == {0}
    assert {r["total_buildings"] for r in rows} == {fx.footprints(spark, SF_SMALL).count()}


def test_null_rules_for_cells_without_height(spark):
    df = spark.createDataFrame(
        [(10.0, 10.0, 1e-8, -999.0), (10.0, 10.0, 1e-8, -999.0), (20.0, 20.0, 1e-8, 5.0)],
        "lat double, lon double, area_deg2 double, height double",
    )
    idx = ix.build_index(df, [5]).orderBy("h3_index").collect()
    nh = [r for r in idx if r["building_count"] == 2][0]
    assert nh["avg_height_m"] is None and nh["max_height_m"] is None and nh["height_std_m"] is None
    assert nh["total_volume_m3"] == 0.0
    compat = ix.build_index(df, [5], compat_std=True).where("building_count = 2").collect()[0]
    assert compat["height_std_m"] == 0.0
    one = [r for r in idx if r["building_count"] == 1][0]
    assert one["max_height_m"] == 5.0 and one["height_std_m"] == 0.0


def test_split_without_heights_keeps_max(spark):
    # one tile of a cell has no heights: its partial max is NULL, not NaN
    df = spark.createDataFrame(
        [("a", 10.0, 10.0, 1e-8, -999.0), ("b", 10.0, 10.0, 1e-8, 7.0)],
        "tile_id string, lat double, lon double, area_deg2 double, height double",
    )
    merged = ix.merge_partials(ix.partials(df, [5])).collect()[0]
    assert merged["max_height_m"] == 7.0 and merged["building_count"] == 2


def test_rows_go_together_by_place_before_they_are_exploded(spark):
    fp = fx.footprints(spark, SF_SMALL)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan(ix.build_index(fp)) and "RebalancePartitions" in plan(ix.partials(fp))
    assert "RebalancePartitions" not in plan(ix.build_index(fp, [3, 8]))  # one fine resolution: partial sums shrink as they are
    rows = fp.select("lat", "lon")
    assert _rows(ix.near_together(rows, [7, 8], "lat", "lon")) == _rows(rows)
