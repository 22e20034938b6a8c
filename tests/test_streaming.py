from conftest import SF_SMALL
from tessera.operators import index as ix
from tessera.sources import fixtures as fx
from tessera.streaming.incremental import merge_stream_partials, read_stream_rejects, start_partials_stream, stream_rejects


def test_available_now_batches_merge_to_direct(spark, tmpdir_path):
    src = f"{tmpdir_path}/incoming"
    b = fx.buildings(spark, SF_SMALL).drop("half")
    schema = b.drop("tile_id").schema
    b.where("lon < 0").repartition("tile_id").write.partitionBy("tile_id").parquet(src)
    q = start_partials_stream(spark, src, schema, f"{tmpdir_path}/partials", f"{tmpdir_path}/ckpt", [5])
    q.awaitTermination()
    b.where("lon >= 0").repartition("tile_id").write.mode("append").partitionBy("tile_id").parquet(src)
    q = start_partials_stream(spark, src, schema, f"{tmpdir_path}/partials", f"{tmpdir_path}/ckpt", [5])
    q.awaitTermination()
    got = sorted(map(tuple, merge_stream_partials(spark, f"{tmpdir_path}/partials").collect()))
    exp = sorted(map(tuple, ix.build_index(fx.footprints(spark, SF_SMALL), [5]).collect()))
    assert len(got) == len(exp)
    for x, y in zip(got, exp):
        assert x[:3] == y[:3]


def test_a_new_checkpoint_neither_overwrites_nor_counts_twice(spark, tmpdir_path):
    src, parts = f"{tmpdir_path}/incoming", f"{tmpdir_path}/partials"
    b = fx.buildings(spark, SF_SMALL).drop("half", "tile_id")
    bad = spark.createDataFrame([("bad", "x", "y", 5.0, 0.0, bytearray(b"\x01\x03\x00"))], b.schema)
    for i, rows in enumerate((b.where("source < 'N'"), b.where("source >= 'N'").unionByName(bad))):
        rows.coalesce(2).write.mode("append").parquet(src)
        start_partials_stream(spark, src, b.schema, parts, f"{tmpdir_path}/ckpt{i}", [5], rejects_path=f"{tmpdir_path}/rejects").awaitTermination()
    idx = merge_stream_partials(spark, parts)
    assert idx.agg({"building_count": "sum"}).first()[0] == b.count() and idx.where("h3_index IS NULL").isEmpty()
    assert [r["rejected"] for r in stream_rejects(spark, parts).collect()] == [1]
    assert [(r["row_index"] >= 0, r["reason"]) for r in read_stream_rejects(spark, f"{tmpdir_path}/rejects").collect()] == [(True, "cut_short")]
