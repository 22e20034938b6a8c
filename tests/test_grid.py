import math

from pyspark.sql import functions as F

from tessera.functions import grid


def test_specs_match_survey_table():
    expected = {3: (335, 123, 12378.731), 4: (885, 325, 1773.370), 5: (2342, 861, 252.951),
                6: (6198, 2278, 36.126), 7: (16397, 6027, 5.1613), 8: (43383, 15946, 0.73732)}
    for r, (n, m, a) in expected.items():
        s = grid.SPECS[r]
        assert (s.n, s.m) == (n, m)
        assert math.isclose(s.area_km2, a, rel_tol=1e-4)


def test_equal_area_sums_to_sphere():
    sphere = 4 * math.pi * grid.EARTH_RADIUS_KM**2
    for s in grid.SPECS:
        assert math.isclose(s.area_km2 * s.n * s.m, sphere, rel_tol=1e-12)


def test_centre_roundtrip_and_properties(spark):
    pts = spark.range(0, 2000).selectExpr(
        "((id * 7919) % 35900) / 100.0e0 - 179.5e0 AS lon", "((id * 104729) % 17000) / 100.0e0 - 85.0e0 AS lat"
    )
    for r in (0, 3, 5, 8, 12, 15):
        c = pts.select(grid.cell_of("lat", "lon", r).alias("c"))
        back = c.select(
            "c",
            grid.cell_res("c").alias("res"),
            grid.cell_of(grid.cell_lat("c"), grid.cell_lon("c"), r).alias("c2"),
            grid.hex_to_cell("lower(hex(c))").alias("c3"),
        )
        bad = back.where("res <> {} OR c <> c2 OR c <> c3".format(r)).count()
        assert bad == 0, r


def test_antimeridian_shares_cell(spark):
    df = spark.createDataFrame([(10.0, 180.0), (10.0, -180.0)], "lat double, lon double")
    cells = {r[0] for r in df.select(grid.cell_of("lat", "lon", 5)).collect()}
    assert len(cells) == 1


def test_poles_and_boundary(spark):
    df = spark.createDataFrame([(90.0, 0.0), (-90.0, 0.0), (45.0, 10.0)], "lat double, lon double")
    rows = df.select(grid.cell_of("lat", "lon", 4).alias("c")).select(
        "c", grid.cell_lat("c").alias("clat"), F.size(grid.cell_boundary("c")).alias("nv")
    ).collect()
    assert rows[0]["clat"] == 90.0 and rows[1]["clat"] == -90.0
    assert all(r["nv"] == 6 for r in rows)


def test_lat_band_range_covers_band(spark):
    pts = spark.range(0, 3000).selectExpr("((id * 7919) % 36000) / 100.0e0 - 180.0e0 AS lon",
                                          "20.0e0 + ((id * 31) % 1500) / 100.0e0 AS lat")
    lo, hi = grid.lat_band_id_range(6, 20.0, 35.0)
    c = pts.select(grid.cell_of("lat", "lon", 6).alias("c"))
    assert c.where(f"c < {lo} OR c > {hi}").count() == 0


def test_boundary_surrounds_centre_and_tiles(spark):
    pts = spark.range(0, 3000).selectExpr(
        "((id * 7919) % 34000) / 100.0e0 - 170.0e0 AS lon", "((id * 104729) % 14000) / 100.0e0 - 70.0e0 AS lat"
    )
    cells = pts.select(grid.cell_of("lat", "lon", 6).alias("c")).distinct()
    rows = cells.select(
        "c", grid.cell_lat("c").alias("clat"), grid.cell_lon("c").alias("clon"), grid.cell_boundary("c").alias("b")
    ).collect()
    for r in rows:
        lats = [v["lat"] for v in r["b"]]
        lons = [v["lon"] for v in r["b"]]
        assert min(lats) < r["clat"] < max(lats)
        assert min(lons) < r["clon"] < max(lons)
    # every point lies in the cell whose boundary box contains it
    check = pts.select("lat", "lon", grid.cell_of("lat", "lon", 6).alias("c")).select(
        "lat", "lon", grid.cell_boundary("c").alias("b")
    ).collect()
    for r in check:
        lats = [v["lat"] for v in r["b"]]
        lons = [v["lon"] for v in r["b"]]
        assert min(lats) - 1e-9 <= r["lat"] <= max(lats) + 1e-9
        assert min(lons) - 1e-9 <= r["lon"] <= max(lons) + 1e-9
