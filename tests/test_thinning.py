import math
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tessera.functions.tiles import snap_cell
from tessera.operators import thinning as th
from tessera.sources import fixtures as fx

GOLDEN_SF001 = [15, 27, 86, 103, 109, 117, 144, 184, 291, 573, 1438, 4286, 52627]


def test_golden_zoom_histogram(spark):
    pts = fx.footprints(spark, SF_MID).select("id", "lon", "lat")
    a = th.assign_zoom(pts, 2, 14, key="id")
    hist = [r["n"] for r in a.groupBy("zoomlevel").agg(F.count("*").alias("n")).orderBy("zoomlevel").collect()]
    assert hist == GOLDEN_SF001
    assert sum(hist) == 60000


def test_one_pick_per_snap_cell_and_rows_preserved(spark, tmpdir_path):
    pts = fx.footprints(spark, SF_SMALL).select("id", "lon", "lat")
    picks = th.zoom_picks(pts, 2, 9, key="id", workdir=tmpdir_path)
    j = picks.join(pts, "id")
    for z in range(2, 9):
        sx, sy = snap_cell("lon", "lat", z)
        per = j.where(F.col("zoomlevel") == z).groupBy(sx, sy).count()
        assert per.where("count > 1").count() == 0
    a = th.attach_zoom(pts, picks, 9, key="id")
    assert a.count() == pts.count()
    assert a.select("id").distinct().count() == pts.count()


def test_resume_reuses_committed_passes(spark, tmpdir_path):
    pts = fx.footprints(spark, SF_SMALL).select("id", "lon", "lat")
    first = sorted(th.zoom_picks(pts, 2, 6, key="id", workdir=tmpdir_path).collect())
    folders = set(os.listdir(tmpdir_path))
    second = sorted(th.zoom_picks(pts, 2, 6, key="id", workdir=tmpdir_path).collect())
    assert first == second and set(os.listdir(tmpdir_path)) == folders
    # other input and another zoom range get folders of their own
    other = pts.withColumn("lon", F.col("lon") * 0.5)
    assert sorted(th.zoom_picks(other, 2, 6, key="id", workdir=tmpdir_path).collect()) == sorted(th.zoom_picks(other, 2, 6, key="id").collect())
    th.zoom_picks(pts, 2, 7, key="id", workdir=tmpdir_path)
    assert len(os.listdir(tmpdir_path)) == 3


def plain(points, minzoom, maxzoom):
    left, out = sorted(points), {}
    for z in range(minzoom, maxzoom):
        p, seen = 360.0 / 2**z, set()
        for key, lon, lat in left:
            cell = math.floor(lon / p + 0.5), math.floor(lat / p + 0.5)
            if cell not in seen:
                seen.add(cell)
                out[key] = z
        left = [x for x in left if x[0] not in out]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_candidates_lose_no_pick_on_dense_points(spark, seed):
    """Far more points to a base cell than the limit, many on cell borders."""
    r = random.Random(seed)
    step = 360.0 / 2**6
    points = [(i, r.choice([r.uniform(-9, 9), step * r.randrange(-3, 3), step / 2 * r.randrange(-6, 6)]), r.choice([r.uniform(-4, 4), 0.0, step])) for i in range(3000)]
    r.shuffle(points)
    df = spark.createDataFrame(points, "id long, lon double, lat double")
    got = {x["id"]: x["zoomlevel"] for x in th.zoom_picks(df, 2, 6, key="id").collect()}
    assert got == plain(points, 2, 6)
    kept = th._candidates(df.withColumnRenamed("id", "__sk"), 2, 6, "lon", "lat").count()
    assert kept < len(points)


@pytest.mark.parametrize("seed", [4, 5])
def test_regions_give_the_picks_of_the_whole(spark, seed):
    """Three tiers, clusters across region borders, points on cell borders."""
    r = random.Random(seed)
    step = 360.0 / 2**8
    edge = lambda: step * 8 * r.randrange(-4, 4) + r.choice([0.0, step / 2, -step / 2, r.gauss(0, step), r.gauss(0, step / 50)])
    points = [(i, edge() if i % 3 else r.uniform(-180, 180), edge() if i % 3 else r.uniform(-90, 90)) for i in range(6000)]
    keys = list(range(len(points)))
    r.shuffle(keys)
    points = [(k, *p[1:]) for k, p in zip(keys, points)]
    df = spark.createDataFrame(points, "id long, lon double, lat double")
    for minzoom, maxzoom in ((2, 12), (7, 9)):
        got = {x["id"]: x["zoomlevel"] for x in th.zoom_picks(df, minzoom, maxzoom, key="id").collect()}
        assert got == plain(points, minzoom, maxzoom)


def test_points_without_a_place_share_a_cell(spark):
    rows = [(1, 5.0, 5.0), (2, None, None), (3, None, None), (4, 1e18, 5.0), (5, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double")
    got = {x["id"]: x["zoomlevel"] for x in th.zoom_picks(df, 2, 9, key="id").collect()}
    assert got == {1: 2, 2: 2, 4: 2, 3: 3, 5: 3}


def test_no_points_give_no_picks(spark):
    assert th.zoom_picks(spark.createDataFrame([], "id long, lon double, lat double"), 2, 9, key="id").count() == 0


def test_counts_without_a_join(spark):
    pts = fx.footprints(spark, SF_SMALL).select("id", "lon", "lat")
    picks = th.zoom_picks(pts, 2, 9, key="id")
    assigned = th.attach_zoom(pts, picks, 9, key="id").groupBy("zoomlevel").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, th.zoom_counts(pts, picks, 9).collect())) == sorted(map(tuple, assigned.collect()))


def test_key_of_several_columns(spark):
    pts = fx.footprints(spark, SF_SMALL).selectExpr("split(id, '-')[0] AS a", "split(id, '-', 2)[1] AS b", "lon", "lat").dropDuplicates(["a", "b"])
    got = th.assign_zoom(pts, 2, 8, key=["a", "b"])
    assert got.count() == pts.count() and got.columns == ["a", "b", "zoomlevel"]


def test_a_region_is_not_held_whole():
    """Picks come out batch after batch, whatever the size of a region, and are those of the whole."""
    import pandas as pd

    r = random.Random(7)
    points = [(i, r.uniform(0, 2), r.uniform(0, 2)) for i in range(600)]
    rows = []
    for i, lon, lat in points:
        cells = {f"{c}{z}": math.floor(v / (360.0 / 2**z) + 0.5) for z in range(10, 14) for c, v in (("x", lon), ("y", lat))}
        small = {c: cells[c] ^ (cells[coarser] << 1) for c, coarser in th._finer(10, 14)}
        rows.append({"__sk": i, **cells, **small, "rx": 0, "ry": 0, "home": True})
    read = []
    batches = (read.append(i) or pd.DataFrame(rows[i : i + 40]) for i in range(0, 600, 40))
    picks = th._region_picks(10, 14)(batches)
    got = [next(picks)]
    assert read == [0]
    got = {k: z for f in [*got, *picks] for k, z in zip(f["__sk"], f["zoomlevel"])}
    assert got == plain(points, 10, 14)


def test_rows_of_a_tier_are_few_and_small(spark, tmpdir_path):
    """No stage of all candidates is written, and each tier has a limit of its own."""
    r = random.Random(8)
    points = [(i, r.uniform(-9, 9), r.uniform(-4, 4)) for i in range(3000)]
    df = spark.createDataFrame(points, "id long, lon double, lat double")
    got = {x["id"]: x["zoomlevel"] for x in th.zoom_picks(df, 2, 8, key="id", workdir=tmpdir_path).collect()}
    assert got == plain(points, 2, 8)
    (work,) = os.listdir(tmpdir_path)
    assert set(os.listdir(f"{tmpdir_path}/{work}")) == {"points", "picks-2-6", "picks-6-8"}
