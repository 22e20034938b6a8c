"""Validation of inputs and outputs: quarantine, index and pyramid checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.grid import cell_area_any_sql, cell_lat_any_sql, cell_lon_any_sql
from tessera.functions.measures import geometry_type, with_measures


def split_valid(measured: DataFrame, cols=("lon", "lat", "area_deg2")) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rows whose geometry could not be measured go aside.

    One bad row no longer costs its whole tile; ``quarantine_counts`` tells
    how many were set aside.
    """
    ok = None
    for c in cols:
        cond = F.col(c).isNotNull() & ~F.isnan(c)
        ok = cond if ok is None else ok & cond
    return measured.where(ok), measured.where(~ok | ok.isNull())


def quarantine_counts(measured: DataFrame, cols=("lon", "lat", "area_deg2")) -> DataFrame:
    ok = None
    for c in cols:
        cond = F.col(c).isNotNull() & ~F.isnan(c)
        ok = cond if ok is None else ok & cond
    status = F.when(ok, F.lit("valid")).otherwise(F.lit("rejected"))
    return measured.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def consistency(idx: DataFrame) -> DataFrame:
    """Buildings per resolution and the max - min spread (should be 0)."""
    per = idx.groupBy("h3_res").agg(F.sum("building_count").cast("long").alias("total_buildings"))
    # ``per`` has one row per resolution (at most 16): a global window is fine
    w = Window.partitionBy()
    spread = F.max("total_buildings").over(w) - F.min("total_buildings").over(w)
    return per.select("h3_res", "total_buildings", spread.alias("max_diff")).orderBy("h3_res")


def resolution_stats(idx: DataFrame) -> DataFrame:
    """Per resolution: cells, buildings, centre lat/lon extent, mean cell area."""
    x = idx.selectExpr(
        "h3_res",
        "building_count",
        f"{cell_lat_any_sql('h3_index')} AS lat",
        f"{cell_lon_any_sql('h3_index')} AS lon",
        f"{cell_area_any_sql('h3_index')} AS area_km2",
    )
    return (
        x.groupBy("h3_res")
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.sum("building_count").cast("long").alias("total_buildings"),
            F.min("lat").cast("float").alias("lat_min"),
            F.max("lat").cast("float").alias("lat_max"),
            F.min("lon").cast("float").alias("lon_min"),
            F.max("lon").cast("float").alias("lon_max"),
            F.avg("area_km2").cast("float").alias("avg_area_km2"),
        )
        .orderBy("h3_res")
    )


def metric_summary(idx: DataFrame) -> DataFrame:
    """Per resolution: mean/max density and coverage, heights, volume, footprint."""

    def no_nan(c):
        return F.nanvl(F.col(c), F.lit(None).cast("float"))

    return (
        idx.groupBy("h3_res")
        .agg(
            F.avg("building_density").cast("float").alias("avg_density"),
            F.max("building_density").cast("float").alias("max_density"),
            F.avg("coverage_ratio").cast("float").alias("avg_coverage"),
            F.max("coverage_ratio").cast("float").alias("max_coverage"),
            F.avg(no_nan("avg_height_m")).cast("float").alias("avg_height"),
            F.max(no_nan("max_height_m")).cast("float").alias("tallest"),
            F.sum("total_volume_m3").cast("float").alias("total_volume"),
            F.avg("avg_footprint_m2").cast("float").alias("avg_footprint"),
        )
        .orderBy("h3_res")
    )


def validate_index(idx: DataFrame) -> dict[str, DataFrame]:
    """All index checks as frames (schema, per-res stats, metrics, consistency)."""
    from tessera.operators.profile import describe_schema

    return {
        "schema": describe_schema(idx),
        "resolution_stats": resolution_stats(idx),
        "metric_summary": metric_summary(idx),
        "consistency": consistency(idx),
    }


def index_checks(idx: DataFrame) -> DataFrame:
    """(check_name, value, ok) of an index: repeated and missing cells, negative
    metrics, and buildings that differ between resolutions."""
    bad = "building_count <= 0 OR building_density < 0 OR total_footprint_m2 < 0 OR coverage_ratio < 0 OR total_volume_m3 < 0"
    flat = idx.agg(
        F.count_if(F.col("h3_index").isNull()).alias("null_cells"),
        F.count_if(F.expr(bad)).alias("negative_metrics"),
        F.count_if(F.expr("max_height_m < avg_height_m - 0.001")).alias("mean_above_max"),
    )
    repeated = idx.groupBy("h3_index").count().agg(F.count_if(F.col("count") > 1).alias("repeated_cells"))
    spread = consistency(idx).agg(F.coalesce(F.max("max_diff"), F.lit(0)).alias("buildings_max_diff"))
    rows = [f.select(F.lit(c).alias("check_name"), F.col(c).cast("long").alias("value")) for f, cs in ((flat, flat.columns), (repeated, ["repeated_cells"]), (spread, ["buildings_max_diff"])) for c in cs]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("ok", F.col("value") == 0)


def zoom_distribution(pyr: DataFrame) -> DataFrame:
    return pyr.groupBy("zoomlevel").agg(F.count(F.lit(1)).alias("n")).orderBy("zoomlevel")


def geometry_types(df: DataFrame, geometry: str = "geometry", n: int | None = None) -> DataFrame:
    """Rows per geometry type, most frequent first; ``n`` keeps so many types."""
    per = (
        df.groupBy(geometry_type(geometry).alias("geometry_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "geometry_type")
    )
    return per if n is None else per.limit(n)


def crowded_cells(points: DataFrame, maxzoom: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``(zoomlevel, n, crowded)``: rows of each zoom, and its snap cells below maxzoom that hold more than
    one of them. Rows are counted by cell once; at maxzoom all go together."""
    below = F.col("zoomlevel") < maxzoom
    step = "360.0e0 / power(2.0e0, zoomlevel)"
    cell = [F.when(below, F.expr(f"floor({c} / ({step}) + 0.5e0)")).alias(n) for c, n in ((lon, "sx"), (lat, "sy"))]
    per = points.groupBy("zoomlevel", *cell).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("zoomlevel").agg(F.sum("n").alias("n"), F.count_if(below & (F.col("n") > 1)).alias("crowded"))


STRETCH_SCHEMA = "file_path string, first_row long, bad long, first_zoom int, first_quadkey string, last_zoom int, last_quadkey string"


def _stretches(batches):
    """Each batch's stretches of one file: where they begin and end, and rows inside that come before the one ahead."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def steps(column):
        """Of each row but the first: whether it is less than the one ahead, and whether it equals it. Nulls come first."""
        now, ahead = column.slice(1), column.slice(0, len(column) - 1)
        less = pc.if_else(pc.is_null(now), pc.is_valid(ahead), pc.fill_null(pc.less(now, ahead), False))
        same = pc.if_else(pc.is_null(now), pc.is_null(ahead), pc.fill_null(pc.equal(now, ahead), False))
        return less.to_numpy(zero_copy_only=False), same.to_numpy(zero_copy_only=False)

    for b in batches:
        if not b.num_rows:
            continue
        (less_zoom, same_zoom), (less_key, _), (_, same_file) = (steps(b.column(c)) for c in ("zoomlevel", "quadkey", "file_path"))
        bad = np.r_[False, same_file & (less_zoom | (same_zoom & less_key))].astype(np.int64)
        first = np.r_[0, np.flatnonzero(~same_file) + 1]
        last = np.r_[first[1:] - 1, b.num_rows - 1]
        at = lambda c, rows: b.column(c).take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [at("file_path", first), at("row_index", first), pa.array(np.add.reduceat(bad, first)), at("zoomlevel", first), at("quadkey", first), at("zoomlevel", last), at("quadkey", last)],
            names=["file_path", "first_row", "bad", "first_zoom", "first_quadkey", "last_zoom", "last_quadkey"],
        )


def unsorted_rows(scan: DataFrame) -> DataFrame:
    """One row, ``n``: rows of a pyramid's file scan that come before the row
    ahead of them in (zoomlevel, quadkey).

    Rows are compared where they are read, in the order of their file; only where stretches of a file begin
    and end is shuffled.
    """
    x = scan.select("zoomlevel", "quadkey", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    w = Window.partitionBy("file_path").orderBy("first_row")
    border = F.struct("first_zoom", "first_quadkey") < F.lag(F.struct("last_zoom", "last_quadkey")).over(w)
    found = x.mapInArrow(_stretches, STRETCH_SCHEMA).select((F.col("bad") + F.coalesce(border, F.lit(False)).cast("long")).alias("bad"))
    return found.agg(F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("n"))


def validate_pyramid(pyr: DataFrame, source_rows: int, maxzoom: int, scan: DataFrame | None = None, geometry: str = "geometry") -> DataFrame:
    """(check_name, value, ok) of a pyramid.

    * total_rows: as many as the source has;
    * zoom_<z>_rows: the rows of a zoom, ok if no snap cell holds two of them
      (every row counts at maxzoom);
    * unknown_zoom_rows: rows without a zoom up to maxzoom;
    * unsorted_rows: with ``scan``, a file scan of the written rows.
    """
    points = with_measures(pyr.select("zoomlevel", geometry), geometry).select("zoomlevel", "lon", "lat")
    known = F.coalesce(F.col("zoomlevel").between(0, maxzoom), F.lit(False))
    # rows of unknown zooms go together: the table per zoom is as short as there are zooms, and is made once
    per = crowded_cells(points.withColumn("zoomlevel", F.when(known, F.col("zoomlevel"))), maxzoom)
    check = lambda name, value, ok: F.struct(name.alias("check_name"), value.cast("long").alias("value"), ok.alias("ok"))
    zooms = F.when(F.col("zoomlevel").isNotNull(), check(F.concat(F.lit("zoom_"), "zoomlevel", F.lit("_rows")), F.col("n"), F.col("crowded") == 0))
    total, lost = (F.coalesce(F.sum(n), F.lit(0)) for n in (F.col("n"), F.when(F.col("zoomlevel").isNull(), F.col("n"))))
    one = per.agg(total.alias("total"), lost.alias("lost"), F.collect_list(zooms).alias("zooms"))
    rest = F.array(check(F.lit("total_rows"), F.col("total"), F.col("total") == source_rows), check(F.lit("unknown_zoom_rows"), F.col("lost"), F.col("lost") == 0))
    out = one.select(F.inline(F.concat(rest, "zooms")))
    if scan is not None:
        order = unsorted_rows(scan).select(F.lit("unsorted_rows").alias("check_name"), F.col("n").alias("value"), (F.col("n") == 0).alias("ok"))
        out = out.unionByName(order)
    return out
