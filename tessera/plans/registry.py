"""Registered queries: one per inventory operator, each with its oracle.

Every query reads the driver tables under ``sf_dir`` (through the
fixture derivation) over the whole table; nothing is sampled or capped
except where a limit is the feature (top-N reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.constants import COMPRESSION, DEFAULT_MAXZOOM, DEFAULT_MINZOOM, DEFAULT_RESOLUTIONS, INDEX_COLUMN_TEXTS, INDEX_COLUMNS, PYRAMID_ROW_GROUP
from tessera.functions import grid
from tessera.functions.measures import footprint_m2, geometry_type, with_measures
from tessera.functions.tiles import in_quad, quadkey, snap_cell
from tessera.operators import index as ix
from tessera.operators import profile as pf
from tessera.operators import queries as qx
from tessera.operators import sketches as sk
from tessera.operators import thinning as th
from tessera.operators import validate as va
from tessera.plans import sql as S
from tessera.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _fp(spark, sf):
    return fx.footprints(spark, sf)


def _idx(spark, sf, res):
    return ix.index_res(ix.build_index(_fp(spark, sf), [res]), res)


TOP_COLS = "h3_index, CAST({lat} AS FLOAT) AS lat, CAST({lon} AS FLOAT) AS lng, building_count, building_density, avg_height_m, coverage_ratio, total_volume_m3"


def _top_sql(res, order, n, where="TRUE", cols=TOP_COLS):
    c = cols.format(lat=S.lat_sql(res), lon=S.lon_sql(res))
    return S.index_query([res], f"SELECT {c} FROM idx WHERE {where} ORDER BY {order} DESC NULLS LAST, h3_index LIMIT {n}")


# ---------------------------------------------------------------------------
# index build
# ---------------------------------------------------------------------------


@register("top_cells_res5", lambda: _top_sql(5, "building_count", 20))
def top_cells_res5(spark, sf):
    """H3 / flagship: the 20 cells with most buildings at resolution 5."""
    return qx.top_cells(_idx(spark, sf, 5), "building_count", 20)


@register("index_all_resolutions", lambda: S.index_query())
def index_all_resolutions(spark, sf):
    """The full v2 index at resolutions 3-8 (plus h3_res)."""
    return ix.build_index(_fp(spark, sf), DEFAULT_RESOLUTIONS)


def _partials_sql():
    ctes = S.cte_base() + S.cte_index("idx", DEFAULT_RESOLUTIONS, group_col="tile_id")
    return S.with_(
        ctes,
        "SELECT CAST(h3_res AS INT) AS h3_res, tile_id, h3_index, CAST(n AS INT) AS building_count, "
        "CAST(fp AS FLOAT) AS total_footprint_m2, CAST(hsum AS FLOAT) AS height_sum, "
        "CAST(hsq AS FLOAT) AS height_sq_sum, CAST(hmax AS FLOAT) AS max_height_m, "
        "CAST(vol AS FLOAT) AS total_volume_m3, CAST(hn AS INT) AS height_count FROM idx_a",
    )


@register("tile_partials", _partials_sql)
def tile_partials(spark, sf):
    """partial sums per (resolution, tile, cell); sums shown as FLOAT."""
    p = ix.partials(_fp(spark, sf), DEFAULT_RESOLUTIONS, tile_col="tile_id")
    dbl = ("total_footprint_m2", "height_sum", "height_sq_sum", "max_height_m", "total_volume_m3")
    return p.select(*[F.col(c).cast("float").alias(c) if c in dbl else F.col(c) for c in p.columns])


@register("merged_split_partials", lambda: S.index_query())
def merged_split_partials(spark, sf):
    """partials of two interleaved tile sets, merged = direct index."""
    part = ix.partials(_fp(spark, sf), DEFAULT_RESOLUTIONS, tile_col="half")
    return ix.merge_partials(part)


@register(
    "cell_counts",
    lambda: S.index_query(body="SELECT h3_res, CAST(count(DISTINCT h3_index) AS BIGINT) AS n_cells FROM idx GROUP BY h3_res"),
)
def cell_counts(spark, sf):
    """distinct cells per resolution."""
    return ix.cell_counts(ix.build_index(_fp(spark, sf)))


def _two_deliveries(spark, sf):
    """All buildings, and those of every second line once more, in a tile of their own."""
    rows = _fp(spark, sf).withColumn("half", F.col("half").cast("string"))
    return rows.unionByName(rows.where("half = '1'").withColumn("half", F.lit("again")))


_TWICE = "twice AS (SELECT * FROM bm UNION ALL SELECT * FROM bm WHERE half = 1)"


def _sketched_sql():
    cells = f"SELECT {grid.cell_sql('lat', 'lon', 8)} AS h3_index, id, h FROM twice"
    return S.with_(
        S.cte_base() + [_TWICE],
        "SELECT h3_index, CAST(count(*) AS BIGINT) AS deliveries, CAST(count(DISTINCT id) AS BIGINT) AS distinct_buildings, "
        "CAST(quantile_disc(h, 0.5) AS FLOAT) AS median_height_m, CAST(quantile_disc(h, 0.9) AS FLOAT) AS p90_height_m "
        f"FROM ({cells}) GROUP BY h3_index",
    )


@register("sketched_cells_res8", _sketched_sql)
def sketched_cells_res8(spark, sf):
    """distinct buildings and height quantiles from merged sketches of overlapping tiles. Small cells are exact."""
    part = sk.sketch_partials(_two_deliveries(spark, sf), [8], tile_col="half")
    out = sk.sketch_metrics(sk.merge_sketches(part), {"median_height_m": 0.5, "p90_height_m": 0.9})
    return out.select(
        "h3_index", F.col("building_count").alias("deliveries"), "distinct_buildings",
        F.col("median_height_m").cast("float").alias("median_height_m"), F.col("p90_height_m").cast("float").alias("p90_height_m"),
    )


def _sketch_errors_sql():
    cells = " UNION ALL ".join(f"SELECT {r} AS h3_res, {grid.cell_sql('lat', 'lon', r)} AS h3_index, id FROM twice" for r in DEFAULT_RESOLUTIONS)
    return S.with_(
        S.cte_base() + [_TWICE],
        "SELECT CAST(h3_res AS INT) AS h3_res, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_buildings, "
        "CAST(0 AS BIGINT) AS cells_off_distinct, CAST(0 AS BIGINT) AS cells_off_median "
        f"FROM (SELECT h3_res, h3_index, count(DISTINCT id) AS n FROM ({cells}) GROUP BY h3_res, h3_index) GROUP BY h3_res",
    )


@register("sketch_error_bounds", _sketch_errors_sql)
def sketch_error_bounds(spark, sf):
    """cells of each resolution whose sketches miss the exact answer by more than the stated bound: none."""
    rows = _two_deliveries(spark, sf)
    merged = sk.merge_sketches(sk.merge_sketches(sk.sketch_partials(rows, tile_col="half"), ["h3_res", "tile_id", "h3_index"]))
    return sk.sketch_errors(rows, merged)


# ---------------------------------------------------------------------------
# index validation
# ---------------------------------------------------------------------------


@register(
    "resolution_consistency",
    lambda: S.index_query(
        body="SELECT h3_res, total_buildings, max(total_buildings) OVER () - min(total_buildings) OVER () AS max_diff "
        "FROM (SELECT h3_res, CAST(sum(building_count) AS BIGINT) AS total_buildings FROM idx GROUP BY h3_res)"
    ),
)
def resolution_consistency(spark, sf):
    """same building total at every resolution; spread max - min."""
    return va.consistency(ix.build_index(_fp(spark, sf)))


def _res_stats_sql():
    lat, lon = S.lat_multi(), S.lon_multi()
    area = S._per_res_case("h3_res", {r: S.lit(grid.SPECS[r].area_km2) for r in DEFAULT_RESOLUTIONS})
    return S.index_query(
        body=f"SELECT h3_res, count(*) AS n_cells, CAST(sum(building_count) AS BIGINT) AS total_buildings, "
        f"CAST(min(lat) AS FLOAT) AS lat_min, CAST(max(lat) AS FLOAT) AS lat_max, "
        f"CAST(min(lon) AS FLOAT) AS lon_min, CAST(max(lon) AS FLOAT) AS lon_max, "
        f"CAST(avg(area) AS FLOAT) AS avg_area_km2 FROM (SELECT h3_res, building_count, {lat} AS lat, "
        f"{lon} AS lon, {area} AS area FROM idx) GROUP BY h3_res"
    )


@register("resolution_stats", _res_stats_sql)
def resolution_stats(spark, sf):
    """per resolution cells, buildings, centre extent, mean cell area."""
    return va.resolution_stats(ix.build_index(_fp(spark, sf)))


def _metric_summary_sql():
    area = S._per_res_case("h3_res", {r: S.lit(grid.SPECS[r].area_km2) for r in DEFAULT_RESOLUTIONS})
    per_cell = (
        f"SELECT h3_res, CAST(n / ({area}) AS FLOAT) AS per_km2, CAST(fp / (1e6 * ({area})) AS FLOAT) AS covered, "
        "CAST(hsum / nullif(hn, 0) AS FLOAT) AS h_mean, CAST(hmax AS FLOAT) AS h_max, CAST(vol AS FLOAT) AS v, "
        "CAST(fp / n AS FLOAT) AS f_mean FROM idx_a"
    )
    return S.index_query(
        body="SELECT CAST(h3_res AS INT) AS h3_res, "
        + ", ".join(
            f"CAST({fn}({c}) AS FLOAT) AS {name}"
            for fn, c, name in (
                ("sum", "v", "total_volume"), ("max", "h_max", "tallest"), ("avg", "h_mean", "avg_height"),
                ("avg", "f_mean", "avg_footprint"), ("avg", "per_km2", "avg_density"), ("max", "per_km2", "max_density"),
                ("avg", "covered", "avg_coverage"), ("max", "covered", "max_coverage"),
            )
        )
        + f" FROM ({per_cell}) GROUP BY h3_res"
    )


@register("metric_summary", _metric_summary_sql)
def metric_summary(spark, sf):
    """per-resolution metric summary."""
    return va.metric_summary(ix.build_index(_fp(spark, sf)))


# ---------------------------------------------------------------------------
# consumer queries
# ---------------------------------------------------------------------------

DENSE_COLS = "h3_index, CAST({lat} AS FLOAT) AS lat, CAST({lon} AS FLOAT) AS lng, building_count, building_density, coverage_ratio, avg_height_m, max_height_m"
TALL_COLS = "h3_index, CAST({lat} AS FLOAT) AS lat, CAST({lon} AS FLOAT) AS lng, building_count, max_height_m, avg_height_m, total_volume_m3"


@register("densest_cells_res8", lambda: _top_sql(8, "building_density", 10, cols=DENSE_COLS))
def densest_cells_res8(spark, sf):
    """H4: ten densest cells at the finest resolution."""
    cols = ["h3_index", "lat", "lng", "building_count", "building_density", "coverage_ratio", "avg_height_m", "max_height_m"]
    return qx.densest(_idx(spark, sf, 8), 10, columns=cols)


@register("dense_cells_res5_over_100k", lambda: _top_sql(5, "building_density", 20, where="building_count > 100000"))
def dense_cells_res5_over_100k(spark, sf):
    """H4 (published form): densest res-5 cells with more than 100,000 buildings."""
    return qx.densest(_idx(spark, sf, 5), 20, min_count=100000)


@register("tallest_cells_res8", lambda: _top_sql(8, "max_height_m", 10, where="max_height_m IS NOT NULL AND NOT isnan(max_height_m)", cols=TALL_COLS))
def tallest_cells_res8(spark, sf):
    """H5/C20: ten cells with the tallest building (height known)."""
    cols = ["h3_index", "lat", "lng", "building_count", "max_height_m", "avg_height_m", "total_volume_m3"]
    return qx.tallest(_idx(spark, sf, 8), 10, columns=cols)


@register(
    "tallest_cells_res8_over_100m",
    lambda: _top_sql(8, "max_height_m", 20, where="max_height_m IS NOT NULL AND NOT isnan(max_height_m) AND max_height_m > 100", cols=TALL_COLS),
)
def tallest_cells_res8_over_100m(spark, sf):
    """H5/C21 (published form): cells whose tallest building exceeds 100 m."""
    cols = ["h3_index", "lat", "lng", "building_count", "max_height_m", "avg_height_m", "total_volume_m3"]
    return qx.tallest(_idx(spark, sf, 8), 20, min_height=100.0, columns=cols)


@register(
    "continent_totals_res5",
    lambda: S.index_query(
        [5],
        f"SELECT continent, CAST(sum(building_count) AS BIGINT) AS buildings, "
        f"TRY_CAST(sum(total_footprint_m2) / 1e6 AS DECIMAL(12,1)) AS footprint_km2, "
        f"TRY_CAST(sum(total_volume_m3) / 1e9 AS DECIMAL(12,1)) AS volume_billion_m3 "
        f"FROM (SELECT {S.continent_sql(5)} AS continent, building_count, total_footprint_m2, total_volume_m3 FROM idx) "
        f"GROUP BY continent ORDER BY buildings DESC",
    ),
)
def continent_totals_res5(spark, sf):
    """Buildings, footprint and volume per continent box."""
    return qx.continent_totals(_idx(spark, sf, 5))


@register(
    "per_capita_res5",
    lambda: S.index_query(
        [5],
        f"SELECT b.h3_index, CAST({S.lat_sql(5, 'b.h3_index')} AS FLOAT) AS lat, "
        f"CAST({S.lon_sql(5, 'b.h3_index')} AS FLOAT) AS lng, "
        f"b.building_count, p.pop_2025, TRY_CAST(CAST(b.building_count AS FLOAT) / NULLIF(p.pop_2025, 0) "
        f"AS DECIMAL(6,3)) AS buildings_per_person FROM idx5 b JOIN pop p ON b.h3_index = p.h3_index "
        f"WHERE p.pop_2025 > 10000 ORDER BY buildings_per_person DESC NULLS LAST, b.h3_index LIMIT 20",
        name="idx5",
        extra=[S.POPULATION_CTE],
    ),
)
def per_capita_res5(spark, sf):
    """Index joined with a population table on the cell id."""
    idx = _idx(spark, sf, 5)
    return qx.per_capita(idx, fx.population(idx), 10000, 20)


SUPPLIER_POINT = ("((s_suppkey * 7919) % 5600) / 16.0e0 - 175", "((s_suppkey * 104729) % 1920) / 16.0e0 - 55")


@register(
    "per_capita_of_suppliers",
    lambda: S.index_query(
        [5],
        f"SELECT b.h3_index, CAST({S.lat_sql(5, 'b.h3_index')} AS FLOAT) AS lat, CAST({S.lon_sql(5, 'b.h3_index')} AS FLOAT) AS lng, "
        "b.building_count, p.pop_2025, TRY_CAST(CAST(b.building_count AS FLOAT) / NULLIF(p.pop_2025, 0) AS DECIMAL(6,3)) "
        "AS buildings_per_person FROM idx5 b JOIN pop p ON b.h3_index = p.h3_index WHERE p.pop_2025 > 1000 "
        "ORDER BY buildings_per_person DESC NULLS LAST, b.h3_index LIMIT 20",
        name="idx5",
        extra=[
            f"places AS (SELECT s_suppkey, {SUPPLIER_POINT[0]} AS lon, {SUPPLIER_POINT[1]} AS lat FROM supplier)",
            f"pop AS (SELECT {grid.cell_sql('lat', 'lon', 5)} AS h3_index, CAST(sum(s_suppkey * 50) AS DOUBLE) AS pop_2025 FROM places GROUP BY 1)",
        ],
    ),
)
def per_capita_of_suppliers(spark, sf):
    """The population is a table of its own, from other input than the index."""
    at = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("s_suppkey", f"{SUPPLIER_POINT[0]} AS lon", f"{SUPPLIER_POINT[1]} AS lat")
    cells = grid.with_cells(at, [5]).withColumnRenamed("cell_5", "h3_index")
    pop = cells.groupBy("h3_index").agg(F.sum(F.col("s_suppkey") * 50).cast("double").alias("pop_2025"))
    return qx.per_capita(_idx(spark, sf, 5), pop, 1000, 20)


@register(
    "hex_export_bbox_res5",
    lambda: S.index_query(
        [5],
        f"SELECT lower(hex(h3_index)) AS h3_hex, building_count, building_density, avg_height_m FROM idx "
        f"WHERE {S.lat_sql(5)} BETWEEN 35 AND 45 AND {S.lon_sql(5)} BETWEEN -10 AND 5 ORDER BY h3_index LIMIT 100",
    ),
)
def hex_export_bbox_res5(spark, sf):
    """Hex ids in a box, ordered by id, first 100."""
    return qx.hex_export(_idx(spark, sf, 5), 35, 45, -10, 5, 100, res=5)


@register(
    "bbox_res5",
    lambda: S.index_query(
        [5],
        f"SELECT h3_index, building_count, building_density, avg_height_m, coverage_ratio, "
        f"CAST({S.lat_sql(5)} AS FLOAT) AS lat, CAST({S.lon_sql(5)} AS FLOAT) AS lng FROM idx "
        f"WHERE {S.lat_sql(5)} BETWEEN 20 AND 35 AND {S.lon_sql(5)} BETWEEN 68 AND 90",
    ),
)
def bbox_res5(spark, sf):
    """Cells whose centre lies in a lat/lng box (all of them)."""
    b = qx.bbox(_idx(spark, sf, 5), 20, 35, 68, 90, res=5)
    return qx.with_centre(b).select(
        "h3_index", "building_count", "building_density", "avg_height_m", "coverage_ratio", "lat", "lng"
    )


@register(
    "index_v1_res5",
    lambda: S.index_query(
        [5],
        f"SELECT lower(hex(h3_index)) AS h3_index, CAST({S.lat_sql(5)} AS FLOAT) AS lat, "
        f"CAST({S.lon_sql(5)} AS FLOAT) AS lon, CAST({S.lit(grid.SPECS[5].area_km2)} AS FLOAT) AS area_km2, "
        + ", ".join(INDEX_COLUMNS[1:])
        + " FROM idx",
    ),
)
def index_v1_res5(spark, sf):
    """The v1 layout (hex id, centre, cell area) derived from v2."""
    return qx.to_v1(_idx(spark, sf, 5), with_geometry=False)


@register(
    "cell_properties_res8",
    lambda: S.index_query(
        [8],
        f"SELECT h3_index, CAST((h3_index >> 52) & 15 AS INT) AS res, lower(hex(h3_index)) AS h3_hex, "
        f"h3_index AS from_hex, CAST({S.lat_sql(8)} AS FLOAT) AS lat, CAST({S.lon_sql(8)} AS FLOAT) AS lng, "
        f"{S.lit(grid.SPECS[8].area_km2)} AS area_km2 FROM idx",
    ),
)
def cell_properties_res8(spark, sf):
    """Resolution, hex string round trip, centre and area of cells."""
    idx = _idx(spark, sf, 8).select("h3_index")
    return idx.select(
        "h3_index",
        grid.cell_res("h3_index").alias("res"),
        grid.cell_to_hex("h3_index").alias("h3_hex"),
        grid.hex_to_cell("lower(hex(h3_index))").alias("from_hex"),
        F.expr(f"CAST({grid.cell_lat_any_sql('h3_index')} AS FLOAT)").alias("lat"),
        F.expr(f"CAST({grid.cell_lon_any_sql('h3_index')} AS FLOAT)").alias("lng"),
        grid.cell_area_km2("h3_index").alias("area_km2"),
    )


# ---------------------------------------------------------------------------
# source profile
# ---------------------------------------------------------------------------


@register(
    "tile_row_counts",
    lambda: S.with_(S.cte_base(), "SELECT tile_id, count(*) AS row_count FROM fp GROUP BY tile_id"),
)
def tile_row_counts(spark, sf):
    """rows per source tile."""
    return pf.tile_row_counts(_fp(spark, sf), "tile_id")


def _heights_sql(src: str = "bm") -> str:
    return S.with_(
        S.cte_base(),
        f"SELECT count(*) AS total_buildings, count(h) AS with_height, count(*) - count(h) AS no_height, "
        f"CAST(avg(h) AS FLOAT) AS avg_height, CAST(quantile_cont(h, 0.5) AS FLOAT) AS median_height, "
        f"CAST(max(h) AS FLOAT) AS max_height, CAST(min(h) AS FLOAT) AS min_height FROM {src}",
    )


@register("height_summary", _heights_sql)
def height_summary(spark, sf):
    """building count, with/without height, avg, exact median, max, min."""
    return pf.height_summary(_fp(spark, sf))


@register(
    "source_distribution",
    lambda: S.with_(
        S.cte_base(),
        "SELECT source, count(*) AS n, CAST(count(*) * 100.0e0 / sum(count(*)) OVER () AS FLOAT) AS pct "
        "FROM fp GROUP BY source",
    ),
)
def source_distribution(spark, sf):
    """F8/G1: rows per source and share of the total."""
    return pf.source_distribution(_fp(spark, sf))


@register(
    "top_regions",
    lambda: S.with_(
        S.cte_base(), "SELECT region, count(*) AS n FROM fp GROUP BY region ORDER BY n DESC, region LIMIT 20"
    ),
)
def top_regions(spark, sf):
    """the 20 regions with most buildings."""
    return pf.top_regions(_fp(spark, sf), 20)


@register(
    "sample_rows",
    lambda: S.with_(
        S.cte_base(),
        "SELECT id, source, region, CAST(height AS FLOAT) AS height, CAST(var AS FLOAT) AS var "
        "FROM fp ORDER BY md5(id || ':42'), id LIMIT 5",
    ),
)
def sample_rows(spark, sf):
    """H8: five repeatable pseudo-random rows without geometry."""
    return pf.sample_rows(fx.buildings(spark, sf).drop("tile_id", "half"), 5, seed=42)


def _describe_sql():
    rel = (
        "SELECT id, source, region, CAST(height AS FLOAT) AS height, CAST(var AS FLOAT) AS var, "
        "CAST(NULL AS BLOB) AS geometry FROM fp"
    )
    # DuckDB type names -> Spark's simpleString names
    names = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT' THEN 'float' WHEN 'DOUBLE' THEN 'double' " \
        "WHEN 'BLOB' THEN 'binary' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"
    return S.with_(S.cte_base(), f"SELECT column_name, {names} AS column_type FROM (DESCRIBE {rel})")


@register("describe_schema", _describe_sql)
def describe_schema(spark, sf):
    """H9: column names and types of the source rows (schema only, no scan)."""
    return pf.describe_schema(fx.buildings(spark, sf).drop("tile_id", "half"))


# ---------------------------------------------------------------------------
# WKB path (C1, C2, C14, V4) and the index built from geometry
# ---------------------------------------------------------------------------


def _wkb_measured(spark, sf):
    return with_measures(fx.buildings(spark, sf))


@register(
    "wkb_measures",
    lambda: S.with_(
        S.cte_base(),
        f"SELECT id, lon, lat, area_deg2, CAST({footprint_m2(S.D.Sql('area_deg2'), S.D.Sql('lat')).t} AS FLOAT) "
        f"AS footprint_m2 FROM fp",
    ),
)
def wkb_measures(spark, sf):
    """Centroid and planar area from WKB; footprint in m2."""
    m = _wkb_measured(spark, sf)
    return m.select(
        "id", "lon", "lat", "area_deg2", footprint_m2(F.col("area_deg2"), F.col("lat")).cast("float").alias("footprint_m2")
    )


@register(
    "geometry_types",
    lambda: S.with_(S.cte_base(), "SELECT 'POLYGON' AS geometry_type, count(*) AS n FROM fp"),
)
def geometry_types(spark, sf):
    """Rows per geometry type read from the WKB header."""
    return va.geometry_types(fx.buildings(spark, sf))


def _multipolygons(spark, sf):
    """Buildings of some regions as multipolygons: of one part, and of two equal ones."""
    one, two = "concat(unhex('010600000001000000'), geometry)", "concat(unhex('010600000002000000'), geometry, geometry)"
    g = f"CASE WHEN region IN ('NATION_1', 'NATION_2') THEN {one} WHEN region = 'NATION_4' THEN {two} ELSE geometry END"
    return fx.buildings(spark, sf).withColumn("geometry", F.expr(g))


@register(
    "wkb_measures_multipolygon",
    lambda: S.with_(
        S.cte_base(),
        "SELECT id, lon, lat, area_deg2 * CASE WHEN region = 'NATION_4' THEN 2 ELSE 1 END AS area_deg2, "
        "CAST(area_deg2 * CASE WHEN region = 'NATION_4' THEN 2 ELSE 1 END * 12392142400.0e0 * cos(lat * (pi() / 180)) AS FLOAT) AS footprint_m2 FROM fp",
    ),
)
def wkb_measures_multipolygon(spark, sf):
    """Measures of single and multiple polygons; the area rule is written out in the SQL."""
    m = with_measures(_multipolygons(spark, sf))
    return m.select(
        "id", "lon", "lat", "area_deg2", footprint_m2(F.col("area_deg2"), F.col("lat")).cast("float").alias("footprint_m2")
    )


@register(
    "geometry_types_mixed",
    lambda: S.with_(
        S.cte_base(),
        "SELECT CASE WHEN region IN ('NATION_1', 'NATION_2', 'NATION_4') THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS geometry_type, "
        "count(*) AS n FROM fp GROUP BY 1",
    ),
)
def geometry_types_mixed(spark, sf):
    """More than one geometry type."""
    return va.geometry_types(_multipolygons(spark, sf))


@register(
    "index_v1_points_res5",
    lambda: S.index_query(
        [5],
        f"SELECT lower(hex(h3_index)) AS h3_index, '0101000000' AS header, 21 AS n_bytes, CAST({S.lat_sql(5)} AS FLOAT) AS lat, "
        f"CAST({S.lon_sql(5)} AS FLOAT) AS lon FROM idx",
    ),
)
def index_v1_points_res5(spark, sf):
    """The v1 layout with its point geometry, read back from the WKB."""
    v1 = qx.to_v1(_idx(spark, sf, 5))
    header, size = F.lower(F.hex(F.substring("geometry", 1, 5))).alias("header"), F.octet_length("geometry").alias("n_bytes")
    m = with_measures(v1.select("h3_index", "geometry"))
    return m.select("h3_index", header, size, F.col("lat").cast("float").alias("lat"), F.col("lon").cast("float").alias("lon"))


def _written_out_sql():
    """The metrics written out by hand, apart from the engine's formula code."""
    area = S.lit(grid.SPECS[5].area_km2)
    return S.with_(
        [
            f"fp AS ({S.footprints_sql()})",
            "m AS (SELECT *, area_deg2 * 12392142400.0e0 * cos(lat * (pi() / 180)) AS m2, CASE WHEN height > 0 THEN height END AS hv FROM fp)",
            f"c AS (SELECT {grid.cell_sql('lat', 'lon', 5)} AS h3_index, m2, hv FROM m)",
        ],
        f"SELECT h3_index, CAST(count(*) AS INT) AS building_count, CAST(count(*) / {area} AS FLOAT) AS building_density, "
        f"CAST(sum(m2) AS FLOAT) AS total_footprint_m2, CAST(sum(m2) / ({area} * 1000000) AS FLOAT) AS coverage_ratio, "
        "CAST(avg(hv) AS FLOAT) AS avg_height_m, CAST(max(hv) AS FLOAT) AS max_height_m, "
        "CAST(coalesce(sum(m2 * hv), 0) AS FLOAT) AS total_volume_m3, CAST(avg(m2) AS FLOAT) AS avg_footprint_m2, "
        "CAST(round(stddev_pop(hv), 2) AS FLOAT) AS height_std_m FROM c GROUP BY h3_index",
    )


@register("index_metrics_written_out", _written_out_sql)
def index_metrics_written_out(spark, sf):
    """F2a-F2h against formulas that share no code with the engine's."""
    idx = _idx(spark, sf, 5)
    std = F.round(F.col("height_std_m").cast("double"), 2).cast("float").alias("height_std_m")
    return idx.select("h3_index", "building_count", "building_density", "total_footprint_m2", "coverage_ratio", "avg_height_m", "max_height_m", "total_volume_m3", "avg_footprint_m2", std)


@register("index_from_wkb", lambda: S.index_query())
def index_from_wkb(spark, sf):
    """T2 from geometry: WKB -> measures -> cells -> index, all resolutions."""
    return ix.build_index(_wkb_measured(spark, sf), DEFAULT_RESOLUTIONS)


@register(
    "quarantine_counts",
    lambda: S.with_(S.cte_base(), "SELECT 'valid' AS status, count(*) AS n FROM fp"),
)
def quarantine_counts(spark, sf):
    """V4: measured rows split into valid / rejected."""
    return va.quarantine_counts(_wkb_measured(spark, sf))


# ---------------------------------------------------------------------------
# pyramid (C11, C12, C13, T1, E1, F12, F16, T3)
# ---------------------------------------------------------------------------

ZOOMS = range(DEFAULT_MINZOOM, DEFAULT_MAXZOOM + 1)


def _snap_sql():
    parts = []
    for z in ZOOMS:
        sx, sy = snap_cell(S.D.Sql("lon"), S.D.Sql("lat"), z)
        parts.append(f"SELECT {z} AS zoomlevel, count(*) AS n_cells FROM (SELECT DISTINCT {sx.t} AS sx, {sy.t} AS sy FROM fp)")
    return S.with_(S.cte_base(), " UNION ALL ".join(parts))


@register("snap_cells_per_zoom", _snap_sql)
def snap_cells_per_zoom(spark, sf):
    """C11: occupied snap-grid cells per zoom (one scan, exploded per zoom)."""
    fp = _fp(spark, sf).select("lon", "lat")
    cells = []
    for z in ZOOMS:
        sx, sy = snap_cell(S.D.Sql("lon"), S.D.Sql("lat"), z)
        cells.append(f"named_struct('zoomlevel', {z}, 'sx', {sx.t}, 'sy', {sy.t})")
    x = fp.selectExpr(f"inline(array({', '.join(cells)}))")
    return x.groupBy("zoomlevel").agg(F.count_distinct("sx", "sy").alias("n_cells"))


@register(
    "quadkeys_z14",
    lambda: S.with_(S.cte_base(), f"SELECT id, {S.quadkey_sql('lon', 'lat', 14)} AS quadkey FROM fp"),
)
def quadkeys_z14(spark, sf):
    """Zoom-14 quadkey of every building centroid."""
    return _fp(spark, sf).select("id", quadkey("lon", "lat", 14).alias("quadkey"))


def _points(spark, sf):
    return _fp(spark, sf).select("id", "lon", "lat")


def _assign(spark, sf):
    pts = _points(spark, sf)
    return th.attach_zoom(pts.select("id"), th.zoom_picks(pts, key="id"), key="id")


def _zoom_counts(spark, sf):
    pts = _points(spark, sf)
    return th.zoom_counts(pts, th.zoom_picks(pts, key="id"))


@register("zoom_assignments", lambda: S.thinning_query("SELECT id, zoomlevel FROM assign"))
def zoom_assignments(spark, sf):
    """Thinning zoom of every building (minzoom 2, maxzoom 14)."""
    return _assign(spark, sf)


@register(
    "zoom_histogram",
    lambda: S.thinning_query("SELECT zoomlevel, count(*) AS n FROM assign GROUP BY zoomlevel"),
)
def zoom_histogram(spark, sf):
    """buildings per zoom level after thinning."""
    return _zoom_counts(spark, sf)


@register(
    "zoom_counters",
    lambda: S.thinning_query(
        "SELECT zoomlevel, assigned, sum(assigned) OVER () - sum(assigned) OVER (ORDER BY zoomlevel "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS remaining FROM "
        "(SELECT zoomlevel, count(*) AS assigned FROM assign GROUP BY zoomlevel)"
    ),
)
def zoom_counters(spark, sf):
    """F16: assigned and still-unassigned rows after each zoom."""
    return th.zoom_counters(_zoom_counts(spark, sf))


def _pyramid(spark, sf):
    from tessera.operators.pyramid import pyramid_frame

    b = fx.buildings(spark, sf).drop("tile_id", "half")
    return pyramid_frame(b, DEFAULT_MINZOOM, DEFAULT_MAXZOOM, key="id")


@register("pyramid_rows", lambda: S.pyramid_rows_sql())
def pyramid_rows(spark, sf):
    """Pyramid rows (zoom, quadkey, source columns); geometry as byte length."""
    p = _pyramid(spark, sf)
    return p.select(
        "zoomlevel", "quadkey", "source", "id", "height", "var", "region",
        F.octet_length("geometry").alias("geom_bytes"),
    )


@register(
    "pyramid_quadrant_rows",
    lambda: S.pyramid_rows_sql(where=f"{S.quadkey_sql('f.lon', 'f.lat', 14)} LIKE '1%'"),
)
def pyramid_quadrant_rows(spark, sf):
    """Pyramid rows in one quadrant (quadkey prefix filter)."""
    p = in_quad(_pyramid(spark, sf), "1")
    return p.select(
        "zoomlevel", "quadkey", "source", "id", "height", "var", "region",
        F.octet_length("geometry").alias("geom_bytes"),
    )


@register(
    "pyramid_geometry_types",
    lambda: S.with_(S.cte_base(), "SELECT 'POLYGON' AS geometry_type, count(*) AS n FROM fp"),
)
def pyramid_geometry_types(spark, sf):
    """Geometry types over the pyramid rows."""
    return va.geometry_types(_pyramid(spark, sf))


# ---------------------------------------------------------------------------
# file-based operators: tiles, sinks read back, ledger job, stream (A*, B*, E4, J1)
# ---------------------------------------------------------------------------


def _scratch(spark, name):
    return th.scratch_dir(spark, name)


def _write_tiles(spark, sf, root, where=None):
    """Fixture buildings as source tiles under ``tile_id=`` folders.

    Range partitioning on (tile_id, id) keeps few files per tile and splits
    a huge tile over several tasks.
    """
    b = fx.buildings(spark, sf).drop("half")
    if where:
        b = b.where(where)
    b.repartitionByRange("tile_id", "id").write.mode("append").partitionBy("tile_id").parquet(root)


@register(
    "source_tiles",
    lambda: S.with_(S.cte_base(), "SELECT tile_id, count(*) AS rows, 'done' AS status FROM fp GROUP BY tile_id"),
)
def source_tiles(spark, sf):
    """Tiles listed from files, rows per tile, tile status."""
    from tessera.sources.readers import list_tiles, read_footprints, tile_status

    root = _scratch(spark, "tiles")
    _write_tiles(spark, sf, root)
    return tile_status(list_tiles(spark, root), read_footprints(spark, root, ["geometry", "height"]))


@register(
    "index_written_res5",
    lambda: S.index_query([5], "SELECT " + ", ".join(INDEX_COLUMNS) + " FROM idx"),
)
def index_written_res5(spark, sf):
    """Index written sorted under h3_res=N, read back with pruning."""
    from tessera.sources.readers import read_index
    from tessera.sources.writers import write_index

    out = _scratch(spark, "index")
    write_index(ix.build_index(_fp(spark, sf)), out)
    return ix.index_res(read_index(spark, out), 5)


@register(
    "incremental_index_job",
    lambda: S.index_query([3, 5], "SELECT h3_res, " + ", ".join(INDEX_COLUMNS) + " FROM idx"),
)
def incremental_index_job(spark, sf):
    """Tiles arrive in two drops; the ledger job processes only new ones."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.readers import read_index

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    _write_tiles(spark, sf, root, "lon < 0")
    run_index_job(spark, root, work, out, [3, 5])
    _write_tiles(spark, sf, root, "lon >= 0")
    run_index_job(spark, root, work, out, [3, 5])
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


@register("streamed_index_res5", lambda: S.index_query([5]))
def streamed_index_res5(spark, sf):
    """Tiles dropped in two batches, streamed (availableNow) into partials, merged."""
    from tessera.streaming.incremental import merge_stream_partials, start_partials_stream

    root, part, ckpt = _scratch(spark, "incoming"), _scratch(spark, "partials"), _scratch(spark, "stream")
    schema = fx.buildings(spark, sf).drop("half", "tile_id").schema
    _write_tiles(spark, sf, root, "lon < 0")
    start_partials_stream(spark, root, schema, part, ckpt, [5]).awaitTermination()
    _write_tiles(spark, sf, root, "lon >= 0")
    start_partials_stream(spark, root, schema, part, ckpt, [5]).awaitTermination()
    return merge_stream_partials(spark, part)


@register("stream_new_checkpoint", lambda: S.index_query([5]))
def stream_new_checkpoint(spark, sf):
    """The second drop is streamed with a new checkpoint over the same partials."""
    from tessera.streaming.incremental import merge_stream_partials, start_partials_stream

    root, part = _scratch(spark, "incoming"), _scratch(spark, "partials")
    schema = fx.buildings(spark, sf).drop("half", "tile_id").schema
    for where in ("lon < 0", "lon >= 0"):
        _write_tiles(spark, sf, root, where)
        start_partials_stream(spark, root, schema, part, _scratch(spark, "stream"), [5]).awaitTermination()
    return merge_stream_partials(spark, part)


@register(
    "index_second_resolution",
    lambda: S.index_query([3, 5, 8], "SELECT h3_res, " + ", ".join(INDEX_COLUMNS) + " FROM idx"),
)
def index_second_resolution(spark, sf):
    """A run of resolutions 3 and 5, then one of 8 into the same index; all three read."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.readers import read_index

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    _write_tiles(spark, sf, root)
    run_index_job(spark, root, work, out, [3, 5])
    run_index_job(spark, root, work, out, [8])
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


@register("late_file_of_done_tile", lambda: S.index_query([5]))
def late_file_of_done_tile(spark, sf):
    """Every tile gets a second file after the job has finished it."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.readers import read_index

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    for where in ("half = 0", "half = 1"):
        _write_tiles(spark, sf, root, where)
        run_index_job(spark, root, work, out, [5])
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


@register(
    "files_leave_the_source",
    lambda: S.with_(
        [*S.cte_base(), "stay AS (SELECT * FROM bmv WHERE NOT (half = 1 AND lon < 0))", *S.cte_index("idx", [3, 5], src="stay")],
        "SELECT h3_res, " + ", ".join(INDEX_COLUMNS) + " FROM idx",
    ),
)
def files_leave_the_source(spark, sf):
    """After a run one folder of files vanishes and another is renamed; the next run counts what is left."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.readers import read_index
    from tessera.sources.writers import _fs_path

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    for folder, where in (("a", "half = 0"), ("b", "half = 1 AND lon < 0"), ("c", "half = 1 AND lon >= 0")):
        _write_tiles(spark, sf, f"{root}/{folder}", where)
    run_index_job(spark, root, work, out, [3, 5])
    fs, gone = _fs_path(spark, f"{root}/b")
    fs.delete(gone, True)
    fs.rename(_fs_path(spark, f"{root}/c")[1], _fs_path(spark, f"{root}/d")[1])
    run_index_job(spark, root, work, out, [3, 5])
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


@register(
    "overlapping_tiles_dedup",
    lambda: S.with_(
        [
            S.cte_base()[0].replace("fp AS", "raw AS", 1),
            "fp AS (SELECT * REPLACE (CASE WHEN (half = 1 OR lon < 0) AND height <> -999 THEN 7.5 ELSE height END AS height) FROM raw)",
            *S.cte_base()[1:],
            *S.cte_index("idx", [3, 5]),
        ],
        "SELECT h3_res, " + ", ".join(INDEX_COLUMNS) + " FROM idx",
    ),
)
def overlapping_tiles_dedup(spark, sf):
    """a second delivery repeats buildings of the first with another height and comes before it in
    path order, so it takes them over; each building counts once."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.readers import read_index

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    height = F.expr("CAST(CASE WHEN height <> -999 THEN 7.5 ELSE height END AS FLOAT)")
    for folder, where in (("z", "half = 0 OR lon < 0"), ("a", "half = 1 OR lon < 0")):
        b = fx.buildings(spark, sf, by_tile=True).drop("half").where(where)
        b = b.withColumn("height", height) if folder == "a" else b
        b.write.option("compression", COMPRESSION).partitionBy("tile_id").parquet(f"{root}/{folder}")
        run_index_job(spark, root, work, out, [3, 5], dedup_by="id")
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


def _metadata_sql():
    texts = ", ".join(f"('column', '{c}', '{t}', '{x}')" for c, (t, x) in INDEX_COLUMN_TEXTS.items())
    return S.index_query(
        [3, 5],
        f"SELECT * FROM (VALUES {texts}) AS v(item, name, type, value) UNION ALL "
        "SELECT 'cells', CAST(h3_res AS VARCHAR), 'BIGINT', CAST(count(*) AS VARCHAR) FROM idx GROUP BY h3_res",
    )


@register("index_metadata", _metadata_sql)
def index_metadata(spark, sf):
    """Columns with their texts and cells per resolution, read back from the document a job wrote."""
    from tessera.plans.index_job import run_index_job
    from tessera.sources.writers import read_metadata

    root, out = _scratch(spark, "tiles"), _scratch(spark, "index")
    _write_tiles(spark, sf, root)
    run_index_job(spark, root, _scratch(spark, "job"), out, [3, 5])
    meta = read_metadata(spark, f"{out}/_metadata.json")
    rows = [("column", c, t, x) for c, (t, x) in meta["columns"].items()]
    rows += [("cells", r, "BIGINT", str(n)) for r, n in meta["cells_per_resolution"].items()]
    return spark.createDataFrame(rows, "item string, name string, type string, value string")


@register(
    "stored_box_by_key",
    lambda: S.index_query(
        [7],
        "SELECT h3_index, building_count, total_footprint_m2 FROM idx "
        f"WHERE {S.lat_sql(7)} BETWEEN -20 AND 40 AND {S.lon_sql(7)} BETWEEN -100 AND -20",
    ),
)
def stored_box_by_key(spark, sf):
    """A box read from an index sorted by the space-filling key; key ranges reach the scan."""
    from tessera.sources.readers import read_index
    from tessera.sources.writers import write_index_by_key

    out = _scratch(spark, "index")
    write_index_by_key(ix.build_index(_fp(spark, sf), [5, 7]), out)
    return qx.box(read_index(spark, out), 7, -20, 40, -100, -20).select("h3_index", "building_count", "total_footprint_m2")


# buildings without a usable geometry, by region: missing, cut short, no polygon at all
BAD_REGIONS = {"NATION_3": "CAST(NULL AS BINARY)", "NATION_7": "substring(geometry, 1, 11)", "NATION_11": "unhex('0103000000FFFFFFFF')"}
BAD_SQL = "region IN (" + ", ".join(f"'{r}'" for r in BAD_REGIONS) + ")"


def _with_bad_rows(spark, sf):
    cases = " ".join(f"WHEN region = '{r}' THEN {e}" for r, e in BAD_REGIONS.items())
    return fx.buildings(spark, sf).withColumn("geometry", F.expr(f"CASE {cases} ELSE geometry END"))


@register(
    "index_with_bad_rows",
    lambda: S.with_(
        [*S.cte_base(), f"good AS (SELECT * FROM bmv WHERE NOT ({BAD_SQL}))", *S.cte_index("idx", [5], src="good")],
        "SELECT * FROM idx",
    ),
)
def index_with_bad_rows(spark, sf):
    """Rows whose geometry cannot be read belong to no cell."""
    return ix.build_index(with_measures(_with_bad_rows(spark, sf)), [5])


@register(
    "quarantine_counts_bad_rows",
    lambda: S.with_(
        S.cte_base(), f"SELECT CASE WHEN {BAD_SQL} THEN 'rejected' ELSE 'valid' END AS status, count(*) AS n FROM fp GROUP BY 1"
    ),
)
def quarantine_counts_bad_rows(spark, sf):
    """V4: both branches of the quarantine."""
    return va.quarantine_counts(with_measures(_with_bad_rows(spark, sf)))


@register(
    "job_counts_with_bad_rows",
    lambda: S.with_(
        S.cte_base(),
        f"SELECT tile_id, 'done' AS status, count(*) AS rows, CAST(count_if({BAD_SQL}) AS BIGINT) AS rejected FROM fp GROUP BY tile_id "
        "UNION ALL SELECT 'none', 'skipped_empty', 0, 0",
    ),
)
def job_counts_with_bad_rows(spark, sf):
    """The ledger of a job over tiles with unreadable rows and an empty tile."""
    from tessera.plans.index_job import read_ledger, run_index_job

    root, work = _scratch(spark, "tiles"), _scratch(spark, "job")
    b = _with_bad_rows(spark, sf).drop("half")
    b.repartitionByRange("tile_id", "id").write.partitionBy("tile_id").parquet(root)
    b.drop("tile_id").limit(0).coalesce(1).write.parquet(f"{root}/tile_id=none")
    run_index_job(spark, root, work, _scratch(spark, "index"), [5])
    led = read_ledger(spark, f"{work}/ledger").groupBy("tile_id", "status")
    return led.agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))


# one region for each reason that a geometry is rejected for
REASON_REGIONS = {
    "NATION_3": ("missing", "CAST(NULL AS BINARY)"),
    "NATION_8": ("cut_short", "substring(geometry, 1, 11)"),
    "NATION_12": ("no_vertices", "unhex('010300000000000000')"),
    "NATION_18": ("not_finite", f"unhex('01030000000100000004000000{'000000000000F87F' * 8}')"),
    "NATION_21": ("unknown_type", "unhex('0163000000')"),
}
REASON_SQL = "CASE region " + " ".join(f"WHEN '{r}' THEN '{why}'" for r, (why, _) in REASON_REGIONS.items()) + " END"


def _rejecting_job(spark, sf):
    """(source, work folder, output, buildings): a job has run over tiles with a row rejected for every reason."""
    from tessera.plans.index_job import run_index_job

    root, work, out = _scratch(spark, "tiles"), _scratch(spark, "job"), _scratch(spark, "index")
    cases = " ".join(f"WHEN region = '{r}' THEN {e}" for r, (_, e) in REASON_REGIONS.items())
    b = fx.buildings(spark, sf, by_tile=True).drop("half")
    bad = b.withColumn("geometry", F.expr(f"CASE {cases} ELSE geometry END"))
    bad.write.option("compression", COMPRESSION).partitionBy("tile_id").parquet(root)
    b = fx.buildings(spark, sf).drop("half")
    run_index_job(spark, root, work, out, [5])
    return root, work, out, b


@register(
    "rejects_by_reason",
    lambda: S.with_(
        S.cte_base(), f"SELECT tile_id, {REASON_SQL} AS reason, count(*) AS n FROM fp WHERE {REASON_SQL} IS NOT NULL GROUP BY ALL"
    ),
)
def rejects_by_reason(spark, sf):
    """V4: the rows that a job set aside, by tile and reason."""
    from tessera.plans.replay import open_rejects

    _, work, _, _ = _rejecting_job(spark, sf)
    return open_rejects(spark, work).groupBy("tile_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@register(
    "index_with_replayed_rows",
    lambda: S.with_(
        [*S.cte_base(), f"good AS (SELECT * FROM bmv WHERE coalesce({REASON_SQL}, 'cut_short') = 'cut_short')", *S.cte_index("idx", [5], src="good")],
        "SELECT * FROM idx",
    ),
)
def index_with_replayed_rows(spark, sf):
    """V4: repaired rows of one reason are replayed and the job runs again."""
    from tessera.plans.index_job import run_index_job
    from tessera.plans.replay import replay
    from tessera.sources.readers import read_index

    root, work, out, b = _rejecting_job(spark, sf)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root).select("id", "_metadata.file_path", "_metadata.row_index")
    replay(spark, root, work, rows.join(b.where(f"{REASON_SQL} = 'cut_short'").select("id", "geometry"), "id"))
    run_index_job(spark, root, work, out, [5])
    return read_index(spark, out).select("h3_res", *INDEX_COLUMNS)


@register(
    "source_tiles_with_empty",
    lambda: S.with_(
        S.cte_base(),
        "SELECT tile_id, count(*) AS rows, 'done' AS status FROM fp GROUP BY tile_id UNION ALL SELECT 'none', 0, 'skipped_empty'",
    ),
)
def source_tiles_with_empty(spark, sf):
    """An empty tile is listed and skipped."""
    from tessera.sources.readers import list_tiles, read_footprints, tile_status

    root = _scratch(spark, "tiles")
    _write_tiles(spark, sf, root)
    fx.buildings(spark, sf).drop("half", "tile_id").limit(0).coalesce(1).write.parquet(f"{root}/tile_id=none")
    return tile_status(list_tiles(spark, root), read_footprints(spark, root, ["geometry", "height"]))


# heights that are no numbers to average: NaN, NULL, and an infinite one
ODD_HEIGHT = (
    "CASE WHEN region = 'NATION_3' THEN CAST('NaN' AS DOUBLE) WHEN region = 'NATION_7' THEN CAST(NULL AS DOUBLE) "
    "WHEN region = 'NATION_11' THEN 3 * height WHEN region = 'NATION_15' THEN CAST('Infinity' AS DOUBLE) ELSE height END"
)


def _odd_heights_sql():
    odd = f"SELECT * EXCLUDE (height), {ODD_HEIGHT} AS height FROM fp"
    valid = "CASE WHEN height IS NULL OR isnan(height) OR height = -999 THEN NULL ELSE height END"
    return _heights_sql(f"(SELECT {valid} AS h FROM ({odd}))")


@register("height_summary_odd_values", _odd_heights_sql)
def height_summary_odd_values(spark, sf):
    """NaN and NULL are no height, an infinite height is the largest."""
    return pf.height_summary(_fp(spark, sf).withColumn("height", F.expr(ODD_HEIGHT)))


# every third height tripled: some above 100 m
TALL_HEIGHT = "CASE WHEN height > 0 AND region IN ('NATION_3', 'NATION_11', 'NATION_15') THEN height * 8 ELSE height END"


@register(
    "tall_buildings_res8_over_100m",
    lambda: S.with_(
        [
            f"fp0 AS ({S.footprints_sql()})",
            f"fp AS (SELECT * EXCLUDE (height), {TALL_HEIGHT} AS height FROM fp0)",
            *S.cte_base()[1:],
            *S.cte_index("idx", [8]),
        ],
        f"SELECT {TALL_COLS.format(lat=S.lat_sql(8), lon=S.lon_sql(8))} FROM idx WHERE max_height_m > 100 "
        "ORDER BY max_height_m DESC, h3_index LIMIT 20",
    ),
)
def tall_buildings_res8_over_100m(spark, sf):
    """H5/C21 on heights that reach the threshold."""
    cols = ["h3_index", "lat", "lng", "building_count", "max_height_m", "avg_height_m", "total_volume_m3"]
    idx = ix.build_index(_fp(spark, sf).withColumn("height", F.expr(TALL_HEIGHT)), [8])
    return qx.tallest(ix.index_res(idx, 8), 20, min_height=100.0, columns=cols)


@register("dense_cells_res5_over_100", lambda: _top_sql(5, "building_density", 20, where="building_count > 100"))
def dense_cells_res5_over_100(spark, sf):
    """H4/C21 with a threshold that cells of the test tables reach."""
    return qx.densest(_idx(spark, sf, 5), 20, min_count=100)


@register(
    "stored_bbox_res5",
    lambda: S.index_query(
        [5],
        f"SELECT h3_index, building_count, CAST({S.lat_sql(5)} AS FLOAT) AS lat, CAST({S.lon_sql(5)} AS FLOAT) AS lng FROM idx "
        f"WHERE {S.lat_sql(5)} BETWEEN -20 AND 40 AND {S.lon_sql(5)} BETWEEN 0 AND 90",
    ),
)
def stored_bbox_res5(spark, sf):
    """C19 on a stored index: the id range of the box reaches the scan."""
    from tessera.sources.readers import read_index
    from tessera.sources.writers import write_index

    out = _scratch(spark, "index")
    write_index(ix.build_index(_fp(spark, sf)), out)
    b = qx.bbox(ix.index_res(read_index(spark, out), 5), -20, 40, 0, 90, res=5)
    return qx.with_centre(b).select("h3_index", "building_count", "lat", "lng")


@register(
    "foreign_layout_index",
    lambda: S.index_query([3, 5], "SELECT h3_res, h3_index, building_count FROM idx"),
)
def foreign_layout_index(spark, sf):
    """An index whose files are all called data.parquet, below folders h3_res=N."""
    from tessera.sources.readers import read_index
    from tessera.sources.writers import _fs_path

    out = _scratch(spark, "foreign")
    idx = ix.build_index(_fp(spark, sf), [3, 5])
    for res in (3, 5):
        ix.index_res(idx, res).coalesce(1).write.parquet(f"{out}/h3_res={res}")
        fs, p = _fs_path(spark, f"{out}/h3_res={res}")
        (part,) = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
        fs.rename(part, _fs_path(spark, f"{out}/h3_res={res}/data.parquet")[1])
    return read_index(spark, out, layout="foreign").select("h3_res", "h3_index", "building_count")


@register(
    "index_checks",
    lambda: "SELECT unnest(['null_cells', 'negative_metrics', 'mean_above_max', 'repeated_cells', 'buildings_max_diff']) "
    "AS check_name, 0::BIGINT AS value, TRUE AS ok FROM (SELECT count(*) AS n FROM lineitem) WHERE n > 0",
)
def index_checks(spark, sf):
    """V2: checks of a whole index."""
    return va.index_checks(ix.build_index(_fp(spark, sf)))


@register(
    "index_checks_broken",
    lambda: S.index_query(
        [3, 5],
        "SELECT 'null_cells' AS check_name, 0::BIGINT AS value, TRUE AS ok "
        "UNION ALL SELECT 'negative_metrics', count(*), FALSE FROM idx WHERE h3_res = 3 "
        "UNION ALL SELECT 'mean_above_max', 0, TRUE "
        "UNION ALL SELECT 'repeated_cells', count(*), FALSE FROM idx WHERE h3_res = 5 "
        "UNION ALL SELECT 'buildings_max_diff', sum(building_count)::BIGINT, FALSE FROM idx WHERE h3_res = 5",
    ),
)
def index_checks_broken(spark, sf):
    """V2: the checks of an index with cells repeated and metrics turned negative."""
    idx = ix.build_index(_fp(spark, sf), [3, 5])
    idx = idx.withColumn("building_density", F.when(F.col("h3_res") == 3, -F.col("building_density")).otherwise(F.col("building_density")))
    return va.index_checks(idx.unionByName(idx.where("h3_res = 5")))


@register(
    "file_row_identity",
    lambda: S.with_(
        S.cte_base(),
        "SELECT id, tile_id, row_number() OVER (PARTITION BY tile_id ORDER BY id) - 1 AS row_index FROM fp",
    ),
)
def file_row_identity(spark, sf):
    """A5: each row's place in its file (one sorted file for each tile)."""
    from tessera.sources.readers import tile_id, with_row_identity

    root = _scratch(spark, "tiles")
    b = fx.buildings(spark, sf).select("id", "tile_id")
    b.repartition("tile_id").sortWithinPartitions("tile_id", "id").write.partitionBy("tile_id").parquet(root)
    rows = with_row_identity(spark.read.option("recursiveFileLookup", "true").parquet(root))
    return rows.select("id", tile_id("file_path").alias("tile_id"), F.col("row_index").cast("long").alias("row_index"))


def _built(spark, sf):
    from tessera.operators.pyramid import build_pyramid

    out = _scratch(spark, "pyramid")
    build_pyramid(fx.buildings(spark, sf).drop("tile_id", "half"), out, key="id")
    return out


# rows in a snap cell of their own zoom, counted apart from the engine's snap functions
CROWDED = (
    "SELECT zoomlevel, count(*) AS crowded FROM (SELECT zoomlevel FROM {src} a JOIN fp ON fp.id = a.id WHERE zoomlevel < 14 "
    "GROUP BY zoomlevel, floor(lon / (360 / 2 ** zoomlevel) + 0.5), floor(lat / (360 / 2 ** zoomlevel) + 0.5) HAVING count(*) > 1) "
    "GROUP BY zoomlevel"
)


def _checks_sql(src: str, unsorted: bool) -> str:
    crowded = CROWDED.format(src=src)
    return S.thinning_query(
        f"SELECT 'total_rows' AS check_name, count(*) AS value, count(*) = (SELECT count(*) FROM fp) AS ok FROM {src} a UNION ALL "
        f"SELECT 'zoom_' || CAST(a.zoomlevel AS VARCHAR) || '_rows', count(*), coalesce(max(c.crowded), 0) = 0 "
        f"FROM {src} a LEFT JOIN ({crowded}) c ON c.zoomlevel = a.zoomlevel GROUP BY a.zoomlevel UNION ALL "
        "SELECT 'unknown_zoom_rows', 0, TRUE" + (" UNION ALL SELECT 'unsorted_rows', 0, TRUE" if unsorted else "")
    )


@register("pyramid_validation", lambda: _checks_sql("assign", True))
def pyramid_validation(spark, sf):
    """The pyramid written as GeoParquet, read back and checked."""
    from tessera.operators.pyramid import read_pyramid, read_pyramid_attributes

    out = _built(spark, sf)
    rows = _fp(spark, sf).count()
    return va.validate_pyramid(read_pyramid(spark, out), rows, DEFAULT_MAXZOOM, read_pyramid_attributes(spark, out))


@register(
    "pyramid_validation_broken",
    lambda: _checks_sql("(SELECT * FROM assign UNION ALL SELECT * FROM assign WHERE zoomlevel = 5)", False),
)
def pyramid_validation_broken(spark, sf):
    """V1: the checks of a pyramid that has one zoom's rows twice."""
    p = _pyramid(spark, sf)
    return va.validate_pyramid(p.unionByName(p.where("zoomlevel = 5")), _fp(spark, sf).count(), DEFAULT_MAXZOOM)


@register(
    "pyramid_metadata",
    lambda: S.thinning_query(
        "SELECT unnest(['rows_written', 'crs', 'quadkey_zoom', 'sort_order', 'columns']) AS key, "
        "unnest([CAST(count(*) AS VARCHAR), 'EPSG:4326', '14', 'zoomlevel,quadkey', "
        "'geometry,height,id,quadkey,region,source,var,zoomlevel']) AS value FROM assign"
    ),
)
def pyramid_metadata(spark, sf):
    """The metadata document of a written pyramid, read back."""
    from tessera.sources.writers import read_metadata

    m = read_metadata(spark, f"{_built(spark, sf)}/_metadata.json")
    rows = [(k, ",".join(sorted(m[k])) if k == "columns" else ",".join(m[k]) if k == "sort_order" else str(m[k]))
            for k in ("rows_written", "crs", "quadkey_zoom", "sort_order", "columns")]
    return spark.createDataFrame(rows, "key string, value string")


@register(
    "one_file_as_source",
    lambda: S.with_(
        S.cte_base(),
        "SELECT tile_id, id, CAST(height AS FLOAT) AS height FROM fp WHERE tile_id || '/' = (SELECT min(tile_id || '/') FROM fp)",
    ),
)
def one_file_as_source(spark, sf):
    """A path that is one file instead of a folder."""
    from tessera.sources.readers import list_tiles, read_footprints

    root = _scratch(spark, "tiles")
    b = fx.buildings(spark, sf).drop("half", "geometry")
    b.repartition("tile_id").write.partitionBy("tile_id").parquet(root)
    return read_footprints(spark, list_tiles(spark, root).first()["path"], ["id", "height"]).select("tile_id", "id", "height")


@register("pyramid_zoom_rows", lambda: S.pyramid_rows_sql(where="a.zoomlevel = 9", cols="quadkey, id, geom_bytes"))
def pyramid_zoom_rows(spark, sf):
    """One zoom of a written pyramid, read from its folder alone."""
    from tessera.operators.pyramid import read_pyramid

    p = read_pyramid(spark, _built(spark, sf), zoom=9)
    return p.select("quadkey", "id", F.octet_length("geometry").alias("geom_bytes"))


@register(
    "stored_quadrant_rows",
    lambda: S.pyramid_rows_sql(where=f"{S.quadkey_sql('f.lon', 'f.lat', 14)} LIKE '12%'", cols="zoomlevel, quadkey, id"),
)
def stored_quadrant_rows(spark, sf):
    """C13 on a stored pyramid: the prefix reaches the Parquet scan."""
    from tessera.operators.pyramid import read_pyramid_attributes

    return in_quad(read_pyramid_attributes(spark, _built(spark, sf)), "12").select("zoomlevel", "quadkey", "id")


def _by_row_sql():
    # tiles in path order, rows in file order: what file and row number order by
    base = f"SELECT * EXCLUDE (id), id AS own_id, tile_id || '/' || id AS id FROM ({S.footprints_sql()})"
    qk = S.quadkey_sql("f.lon", "f.lat", DEFAULT_MAXZOOM)
    return S.with_(
        [f"fp AS ({base})", *S.cte_thinning()],
        f"SELECT a.zoomlevel, {qk} AS quadkey, substring(f.own_id, 1, 3) AS id, f.source, CAST(f.height AS FLOAT) AS height "
        "FROM fp f JOIN assign a ON f.id = a.id",
    )


@register("pyramid_rows_by_row_identity", _by_row_sql)
def pyramid_rows_by_row_identity(spark, sf):
    """Tiles whose ids repeat many times; rows are known by file and row number."""
    from tessera.operators.pyramid import pyramid_frame

    root = _scratch(spark, "tiles")
    b = fx.buildings(spark, sf).drop("half").withColumn("own", F.col("id")).withColumn("id", F.substring("id", 1, 3))
    b.repartition("tile_id").sortWithinPartitions("tile_id", "own").drop("own").write.partitionBy("tile_id").parquet(root)
    p = pyramid_frame(spark.read.option("recursiveFileLookup", "true").parquet(root))
    return p.select("zoomlevel", "quadkey", "id", "source", "height")


def _resumed_sql():
    return S.thinning_query(
        "SELECT zoomlevel, count(*) AS n, 0 AS stages_run_again FROM assign GROUP BY zoomlevel", DEFAULT_MINZOOM, 9
    )


@register("resumed_pyramid_zooms", _resumed_sql)
def resumed_pyramid_zooms(spark, sf):
    """A second run over the same stored tiles resumes from the committed stages of the first, and knows its source
    by its files alone. ``stages_run_again``: stage files that the second run wrote."""
    from tessera.operators.pyramid import pyramid_frame

    root, work = _scratch(spark, "tiles"), _scratch(spark, "resume")
    fx.buildings(spark, sf).drop("half", "tile_id").repartitionByRange("id").sortWithinPartitions("id").write.parquet(root)
    scan = spark.read.parquet(root)
    pyramid_frame(scan, DEFAULT_MINZOOM, 9, key="id", workdir=work)
    stages = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(work).select("path", "modificationTime")
    stages().write.parquet(f"{root}-stages")
    second = pyramid_frame(spark.read.parquet(root), DEFAULT_MINZOOM, 9, key="id", workdir=work)
    again = stages().exceptAll(spark.read.parquet(f"{root}-stages")).agg(F.count(F.lit(1)).cast("int")).first()[0]
    return second.groupBy("zoomlevel").agg(F.count(F.lit(1)).alias("n")).withColumn("stages_run_again", F.lit(again))


def _boundary_sql():
    parts = []
    for k in range(6):
        lon, lat = grid.cell_boundary_sql("h3_index", 5, k)
        parts.append(f"SELECT h3_index, {k} AS vertex, CAST({lon} AS FLOAT) AS lon, CAST({lat} AS FLOAT) AS lat FROM idx")
    return S.index_query([5], " UNION ALL ".join(parts))


@register("cell_boundaries_res5", _boundary_sql)
def cell_boundaries_res5(spark, sf):
    """The six boundary vertices of every occupied res-5 cell."""
    idx = _idx(spark, sf, 5).select("h3_index")
    v = idx.select("h3_index", F.posexplode(grid.cell_boundary("h3_index")).alias("vertex", "p"))
    return v.select("h3_index", "vertex", F.col("p.lon").cast("float").alias("lon"), F.col("p.lat").cast("float").alias("lat"))


@register(
    "geoparquet_footer",
    lambda: S.thinning_query(
        "SELECT '1.1.0' AS version, 'geometry' AS primary_column, 'WKB' AS encoding, 'EPSG:4326' AS crs, count(*) AS rows, "
        "TRUE AS groups_fit FROM assign",
    ),
)
def geoparquet_footer(spark, sf):
    """Footers of the pyramid that ``build_pyramid`` writes, read in tasks."""
    from tessera.sources.geoparquet import geo_footer

    f = geo_footer(spark, _built(spark, sf))
    return f.groupBy("version", "primary_column", "encoding", "crs").agg(
        F.sum("num_rows").alias("rows"), (F.max("largest_group") == F.least(F.lit(PYRAMID_ROW_GROUP), F.max("num_rows"))).alias("groups_fit")
    )


@register(
    "pyramid_files_per_zoom",
    lambda: S.thinning_query("SELECT zoomlevel, count(*) AS rows, TRUE AS files_fit, TRUE AS files_apart FROM assign GROUP BY zoomlevel"),
)
def pyramid_files_per_zoom(spark, sf):
    """Rows of each zoom; no file is larger than asked, and files of a zoom hold quadkeys apart from each other."""
    from tessera.operators.pyramid import build_pyramid, read_pyramid_attributes

    out, most = _scratch(spark, "pyramid"), 2_000
    build_pyramid(fx.buildings(spark, sf).drop("tile_id", "half"), out, key="id", max_file_rows=most)
    rows = read_pyramid_attributes(spark, out).select("zoomlevel", "quadkey", F.col("_metadata.file_path").alias("file"))
    files = rows.groupBy("zoomlevel", "file").agg(F.count(F.lit(1)).alias("n"), F.min("quadkey").alias("low"), F.max("quadkey").alias("high"))
    before = F.max("high").over(Window.partitionBy("zoomlevel").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(before <= F.col("low"), F.lit(True))  # rows of one quadkey may fill several files
    files = files.withColumn("apart", apart)
    return files.groupBy("zoomlevel").agg(F.sum("n").alias("rows"), (F.max("n") <= most).alias("files_fit"), F.every("apart").alias("files_apart"))


@register(
    "per_capita_from_files",
    lambda: S.index_query(
        [5],
        f"SELECT b.h3_index, CAST({S.lat_sql(5, 'b.h3_index')} AS FLOAT) AS lat, "
        f"CAST({S.lon_sql(5, 'b.h3_index')} AS FLOAT) AS lng, "
        f"b.building_count, p.pop_2025, TRY_CAST(CAST(b.building_count AS FLOAT) / NULLIF(p.pop_2025, 0) "
        f"AS DECIMAL(6,3)) AS buildings_per_person FROM idx5 b JOIN pop p ON b.h3_index = p.h3_index "
        f"WHERE p.pop_2025 > 10000 ORDER BY buildings_per_person DESC NULLS LAST, b.h3_index LIMIT 20",
        name="idx5",
        extra=[S.POPULATION_CTE],
    ),
)
def per_capita_from_files(spark, sf):
    """Population side table under scenario=/h3_res= folders, partition-pruned read."""
    from tessera.sources.readers import read_population

    idx = _idx(spark, sf, 5)
    root = _scratch(spark, "population")
    pop = fx.population(idx).withColumn("scenario", F.lit("SSP2")).withColumn("h3_res", F.lit(5))
    pop.write.partitionBy("scenario", "h3_res").parquet(root)
    return qx.per_capita(idx, read_population(spark, root, "SSP2", 5), 10000, 20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
