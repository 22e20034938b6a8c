import glob
import os
import struct

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.functions.measures import reason_of, with_measures
from tessera.operators import index as ix
from tessera.plans.index_job import run_index_job
from tessera.plans.replay import open_rejects, replay
from tessera.sources import fixtures as fx
from tessera.sources.readers import read_index

RING = struct.pack("<BII", 1, 3, 1)
SQUARE = RING + struct.pack("<I10d", 5, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0)


def test_reasons():
    nan = float("nan")
    assert reason_of(SQUARE) is None
    assert reason_of(None) == reason_of(b"") == "missing"
    assert all(reason_of(SQUARE[:n]) == "cut_short" for n in range(1, len(SQUARE)))
    assert reason_of(struct.pack("<BI", 1, 99)) == "unknown_type"
    assert reason_of(struct.pack("<BII", 1, 3, 0)) == reason_of(RING + struct.pack("<I", 0)) == "no_vertices"
    assert reason_of(struct.pack("<BIdd", 1, 1, nan, nan)) == "no_vertices"
    assert reason_of(RING + struct.pack("<I8d", 4, *[nan] * 8)) == "not_finite"


def _sums(idx):
    return sorted(map(tuple, idx.select("h3_index", "building_count").collect()))


@pytest.mark.parametrize("dedup_by", [None, "id"])
def test_repaired_rows_come_back_once_and_leave_with_their_file(spark, tmpdir_path, dedup_by):
    src, work, out = (f"{tmpdir_path}/{x}" for x in ("src", "work", "out"))
    good = fx.buildings(spark, SF_SMALL).drop("half").cache()
    bad = F.expr("CASE WHEN region = 'NATION_3' THEN CAST(NULL AS BINARY) WHEN region = 'NATION_12' THEN substring(geometry, 1, 11) ELSE geometry END")
    tiles = good.withColumn("geometry", bad)
    tiles.repartition("tile_id").write.partitionBy("tile_id").parquet(src)
    run = lambda: run_index_job(spark, src, work, out, [5], dedup_by=dedup_by)
    run()
    got = {(r["tile_id"], r["reason"]): r["count"] for r in open_rejects(spark, work).groupBy("tile_id", "reason").count().collect()}
    why = F.expr("CASE region WHEN 'NATION_3' THEN 'missing' ELSE 'cut_short' END").alias("reason")
    exp = good.where("region IN ('NATION_3', 'NATION_12')").groupBy("tile_id", why).count()
    assert got == {(r["tile_id"], r["reason"]): r["count"] for r in exp.collect()} and got
    # geometry by row, from the file itself: all rows of one region, and one that stays bad
    rows = spark.read.option("recursiveFileLookup", "true").parquet(src).select("id", "_metadata.file_path", "_metadata.row_index")
    fixed = rows.join(good.where("region = 'NATION_12'").select("id", "geometry"), "id").drop("id")
    still = rows.join(good.where("region = 'NATION_3'").select("id"), "id").limit(1).select("file_path", "row_index", F.unhex(F.lit("0103")).alias("geometry"))
    n = good.where("region = 'NATION_12'").count()
    assert replay(spark, src, work, fixed.unionByName(still)) == n > 0
    assert replay(spark, src, work, fixed) == 0  # taken already
    with pytest.raises(ValueError):
        replay(spark, src, work, fixed.unionByName(fixed))
    run()
    whole = good.where("region <> 'NATION_3'")
    expected = lambda rows: _sums(ix.build_index(with_measures(rows), [5]))
    index = lambda: _sums(read_index(spark, out).where("h3_res = 5"))
    assert index() == expected(whole)
    assert open_rejects(spark, work).where("reason = 'cut_short'").isEmpty()
    run()
    assert index() == expected(whole)
    # a file that leaves takes its repaired rows along
    gone = good.where("region = 'NATION_12'").first()["tile_id"]
    for f in glob.glob(f"{src}/tile_id={gone}/*.parquet"):
        os.remove(f)
    run()
    assert index() == expected(whole.where(F.col("tile_id") != gone))
    good.unpersist()


def test_replay_stores_what_it_uses_often_and_few_files(spark, tmpdir_path):
    src, work, out = (f"{tmpdir_path}/{x}" for x in ("src", "work", "out"))
    good = fx.buildings(spark, SF_SMALL).drop("half")
    bad = good.withColumn("geometry", F.expr("CASE WHEN region < 'NATION_3' THEN NULL ELSE geometry END"))
    bad.repartition("tile_id").write.partitionBy("tile_id").parquet(src)
    run_index_job(spark, src, work, out, [5])
    rejected = open_rejects(spark, work).count()
    looked = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def repaired(geometry):
        looked.add(1)
        return geometry

    rows = spark.read.option("recursiveFileLookup", "true").parquet(src).select("id", "_metadata.file_path", "_metadata.row_index")
    fixed = rows.join(good.where("region < 'NATION_3'").select("id", "geometry"), "id").withColumn("geometry", repaired("geometry"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert replay(spark, src, work, fixed) == rejected > 100
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert looked.value == rejected
    files = glob.glob(f"{work}/replays/**/*.parquet", recursive=True)
    assert len(files) == len({os.path.dirname(f) for f in files}) > 5
    assert open_rejects(spark, work).isEmpty()
