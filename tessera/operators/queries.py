"""Consumer queries over the v2 index (top-N, bbox, continents, per capita).

Top-N queries become ``TakeOrderedAndProject`` (a bounded heap per task,
then a merge of n rows per task): no global sort, nothing unbounded on the
driver. Every ordering ends with ``h3_index`` so ties are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.grid import cell_area_km2, cell_lat_any_sql, cell_lon_any_sql, cell_to_hex
from tessera.functions.tiles import bbox, continent_col
from tessera.functions.zones import box_key_ranges, in_box_ranges


def with_centre(idx: DataFrame, lat: str = "lat", lng: str = "lng", as_float: bool = True) -> DataFrame:
    """Add the cell centre. Reported as FLOAT by default, like the v1 layout:
    ``asin`` differs in the last bit between math libraries, FLOAT does not."""
    la, lo = cell_lat_any_sql("h3_index"), cell_lon_any_sql("h3_index")
    if as_float:
        la, lo = f"CAST({la} AS FLOAT)", f"CAST({lo} AS FLOAT)"
    return idx.selectExpr("*", f"{la} AS {lat}", f"{lo} AS {lng}")


def top_cells(idx: DataFrame, by: str = "building_count", n: int = 20, columns=None) -> DataFrame:
    """Top ``n`` cells by a metric (descending), with centre lat/lng."""
    columns = columns or [
        "h3_index",
        "lat",
        "lng",
        "building_count",
        "building_density",
        "avg_height_m",
        "coverage_ratio",
        "total_volume_m3",
    ]
    return with_centre(idx).orderBy(F.col(by).desc_nulls_last(), F.col("h3_index")).limit(n).select(*columns)


def densest(idx: DataFrame, n: int = 10, min_count: int | None = None, columns=None) -> DataFrame:
    """Highest building density, optionally only cells above a count."""
    if min_count is not None:
        idx = idx.where(F.col("building_count") > min_count)
    return top_cells(idx, "building_density", n, columns)


def has_height(idx: DataFrame) -> DataFrame:
    """Cells with a usable maximum height (neither NULL nor NaN)."""
    return idx.where(F.col("max_height_m").isNotNull() & ~F.isnan("max_height_m"))


def tallest(idx: DataFrame, n: int = 10, min_height: float | None = None, columns=None) -> DataFrame:
    idx = has_height(idx)
    if min_height is not None:
        idx = idx.where(F.col("max_height_m") > min_height)
    return top_cells(idx, "max_height_m", n, columns)


def continent_totals(idx: DataFrame) -> DataFrame:
    """Buildings, footprint km2 and volume (1e9 m3) per continent box."""
    c = idx.select(
        continent_col(cell_lat_any_sql("h3_index"), cell_lon_any_sql("h3_index")).alias("continent"),
        "building_count",
        "total_footprint_m2",
        "total_volume_m3",
    )
    return (
        c.groupBy("continent")
        .agg(
            F.sum("building_count").cast("long").alias("buildings"),
            (F.sum("total_footprint_m2") / 1e6).try_cast("decimal(12,1)").alias("footprint_km2"),
            (F.sum("total_volume_m3") / 1e9).try_cast("decimal(12,1)").alias("volume_billion_m3"),
        )
        .orderBy(F.col("buildings").desc(), "continent")
    )


def own_cells(df: DataFrame, cell: str = "h3_index") -> DataFrame:
    """``df``; raises at run time on ids of another grid.

    This grid's ids leave bits 59-62 clear, published H3 cells set one of them: a
    join of the two would match nothing without a word.
    """
    foreign = F.shiftright(F.col(cell), 59).bitwiseAND(F.lit(15)) != 0
    message = F.concat(F.lit("not a cell of this grid: "), F.lower(F.hex(cell)))
    return df.withColumn(cell, F.when(foreign, F.raise_error(message).cast("long")).otherwise(F.col(cell)))


def per_capita(idx: DataFrame, pop: DataFrame, min_pop: float = 10000, n: int = 20) -> DataFrame:
    """Buildings per person on cells with more than ``min_pop`` people.

    An equi-join on the cell id; the population side is filtered first
    (pushed below the join) and AQE picks broadcast or sort-merge from the
    runtime size, so no side is broadcast on faith.
    """
    p = own_cells(pop.where(F.col("pop_2025") > min_pop))
    j = idx.select("h3_index", "building_count").join(p, "h3_index")
    ratio = F.try_divide(F.col("building_count").cast("float"), F.nullif(F.col("pop_2025"), F.lit(0.0))).try_cast(
        "decimal(6,3)"
    )
    return (
        with_centre(j)
        .select("h3_index", "lat", "lng", "building_count", "pop_2025", ratio.alias("buildings_per_person"))
        .orderBy(F.col("buildings_per_person").desc_nulls_last(), "h3_index")
        .limit(n)
    )


def hex_export(idx: DataFrame, lat0, lat1, lon0, lon1, n: int = 100, res: int | None = None) -> DataFrame:
    """Hex-string ids with a few metrics inside a box (ordered by id)."""
    b = bbox(idx, lat0, lat1, lon0, lon1, res=res)
    return (
        b.orderBy("h3_index")
        .limit(n)
        .select(cell_to_hex("h3_index").alias("h3_hex"), "building_count", "building_density", "avg_height_m")
    )


def to_v1(idx: DataFrame, with_geometry: bool = True) -> DataFrame:
    """v2 -> v1 layout: hex id, centre point, lat/lon/area as FLOAT + metrics."""
    from tessera.constants import INDEX_COLUMNS

    cols = [
        cell_to_hex("h3_index").alias("h3_index"),
        F.expr(f"CAST({cell_lat_any_sql('h3_index')} AS FLOAT)").alias("lat"),
        F.expr(f"CAST({cell_lon_any_sql('h3_index')} AS FLOAT)").alias("lon"),
        cell_area_km2("h3_index").cast("float").alias("area_km2"),
        *INDEX_COLUMNS[1:],
    ]
    if with_geometry:
        from tessera.functions.measures import point_wkb

        cols.insert(
            1, point_wkb(F.expr(cell_lon_any_sql("h3_index")), F.expr(cell_lat_any_sql("h3_index"))).alias("geometry")
        )
    return idx.select(*cols)


def box(idx: DataFrame, res: int, lat0: float, lat1: float, lon0: float, lon1: float) -> DataFrame:
    """Cells of ``res`` whose centre lies in the box, of an index written by ``write_index_by_key``.

    A short list of key ranges goes to the scan and prunes row groups on both
    axes; the centres decide. A box with ``lon0`` > ``lon1`` goes over the antimeridian.
    """
    near = in_box_ranges(idx.where(F.col("h3_res") == res), box_key_ranges(res, lat0, lat1, lon0, lon1))
    lat, lon = cell_lat_any_sql("h3_index"), cell_lon_any_sql("h3_index")
    inside = f"{lon} BETWEEN {lon0} AND {lon1}" if lon0 <= lon1 else f"({lon} >= {lon0} OR {lon} <= {lon1})"
    return near.where(f"{lat} BETWEEN {lat0} AND {lat1} AND {inside}")
