"""Cell index: partial aggregates per (tile, cell), additive merge, metrics.

Plan shape of :func:`build_index` (one scan, one shuffle)::

    scan(lat, lon, area_deg2, height)          -- column-pruned parquet
      -> project measures and per-resolution cell ids (codegen)
      -> explode one row per resolution         (the Expand shape)
      -> partial HashAggregate (map-side combine per task)
      -> shuffle on h3_index (the id carries the resolution)
      -> final HashAggregate -> derived metrics -> FLOAT at the sink

Partial aggregation makes hot cells harmless: a cell holding a third of all
buildings still sends one row per map task into the shuffle. With several fine
resolutions, rows that lie anywhere would give nearly one group each, so the narrow rows first go
together by place (:func:`near_together`, one row per building instead of one per
resolution); AQE splits a place that is too large. The same sums
persisted per tile (:func:`partials`) merge additively
(:func:`merge_partials`), so new tiles need no recomputation of old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.constants import DEFAULT_RESOLUTIONS, INDEX_COLUMNS
from tessera.functions import dual as D
from tessera.functions.grid import SPECS, cell_res_sql, with_cells
from tessera.functions.measures import footprint_m2, with_measures

PARTIAL_COLUMNS = (
    "h3_res",
    "tile_id",
    "h3_index",
    "building_count",
    "total_footprint_m2",
    "height_sum",
    "height_sq_sum",
    "max_height_m",
    "total_volume_m3",
    "height_count",
)


def valid_height_sql(height: str) -> str:
    """Height as DOUBLE with the -999 sentinel (and NaN, NULL) as NULL."""
    return (
        f"CASE WHEN {height} IS NULL OR isnan({height}) OR {height} = -999.0e0 "
        f"THEN NULL ELSE CAST({height} AS DOUBLE) END"
    )


def measurable(df: DataFrame, lat: str = "lat", lon: str = "lon", area: str = "area_deg2") -> DataFrame:
    """Rows with a centroid and an area (``validate.quarantine_counts`` counts the others)."""
    return df.where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in (lat, lon, area)))


def with_building_metrics(df: DataFrame, lat="lat", area="area_deg2", height="height", keep=None) -> DataFrame:
    """Add per-building ``fp_m2``, ``h`` (valid height or NULL) and ``vol``."""
    keep = list(keep) if keep is not None else ["*"]
    fp = footprint_m2(D.Sql(area), D.Sql(lat)).t
    x = df.selectExpr(*keep, f"{fp} AS fp_m2", f"{valid_height_sql(height)} AS h")
    return x.selectExpr("*", "fp_m2 * h AS vol")


#: Resolutions whose cells hold few rows of a task that reads buildings from anywhere.
FINE = 7


def near_together(df: DataFrame, resolutions, lat: str, lon: str) -> DataFrame:
    """``df`` with the rows of a place (a square degree) in one task, or several where they are many, if two or more
    resolutions are fine: partial sums of a task then have few groups."""
    if sum(r >= FINE for r in resolutions) < 2:
        return df
    placed = df.selectExpr("*", f"floor({lat}) * 1000 + floor({lon}) AS __place")
    return placed.hint("rebalance", F.col("__place")).drop("__place")


def _exploded_cells(df: DataFrame, resolutions, lat: str, lon: str, keep=()) -> DataFrame:
    """One row per (building, resolution): ``h3_index`` + measures."""
    resolutions = list(resolutions)
    x = with_cells(df, resolutions, lat=lat, lon=lon, prefix="__cell_")
    ids = ", ".join(f"__cell_{r}" for r in resolutions)
    return x.selectExpr(*keep, f"explode(array({ids})) AS h3_index", "fp_m2", "h", "vol")


SUMS_SQL = (
    "count(1) AS n",
    "sum(fp_m2) AS fp",
    "coalesce(sum(h), 0.0e0) AS hsum",
    "count(h) AS hn",
    "coalesce(sum(h * h), 0.0e0) AS hsq",
    "max(h) AS hmax",
    "coalesce(sum(vol), 0.0e0) AS vol",
)


def _sums() -> list:
    return [F.expr(e) for e in SUMS_SQL]


def _ratio(a, b):
    """a / b, NULL when b is 0 (no ANSI error)."""
    if D.is_sql(a):
        return D.Sql(f"({a.t} / NULLIF({D._lit_sql(b)}, 0))")
    return F.try_divide(a, b)


def derive_metrics(n, fp, hsum, hn, hsq, hmax, vol, area, compat_std: bool = False) -> dict:
    """Final metrics from the additive sums; Columns or SQL text alike.

    * avg height over valid heights only, NULL when none;
    * population std from the sums, clamped at 0 before the root; NULL when
      there is no valid height (``compat_std=True`` gives 0, as a plain
      ``GREATEST(NULL, 0)`` does);
    * volume is a sum, 0 when no building has a height.
    """
    mean = _ratio(hsum, hn)
    var = _ratio(hsq, hn) - mean * mean
    std = D.sqrt(D.greatest(var, 0.0))  # GREATEST skips NULL: 0 without heights
    if not compat_std:
        std = D.case((hn > 0, std), otherwise=None)
    return {
        "building_count": D.cast(n, "INT"),
        "building_density": D.cast(n / area, "FLOAT"),
        "total_footprint_m2": D.cast(fp, "FLOAT"),
        "coverage_ratio": D.cast(fp / (area * 1000000.0), "FLOAT"),
        "avg_height_m": D.cast(mean, "FLOAT"),
        "max_height_m": D.cast(hmax, "FLOAT"),
        "height_std_m": D.cast(std, "FLOAT"),
        "total_volume_m3": D.cast(vol, "FLOAT"),
        "volume_density_m3_per_km2": D.cast(vol / area, "FLOAT"),
        "avg_footprint_m2": D.cast(_ratio(fp, n), "FLOAT"),
    }


def _area_of_res_sql(res_col: str = "h3_res") -> str:
    arr = ", ".join(D._lit_sql(float(sp.area_km2)) for sp in SPECS)
    return f"element_at(array({arr}), {res_col} + 1)"


def metrics_sql(compat_std: bool = False, area: str | None = None) -> list[str]:
    """``expr AS name`` texts of the 10 derived metrics over the sum columns."""
    m = derive_metrics(
        *[D.Sql(c) for c in ("n", "fp", "hsum", "hn", "hsq", "hmax", "vol")],
        D.Sql(area or _area_of_res_sql()),
        compat_std=compat_std,
    )
    return [f"{m[c].t} AS {c}" for c in INDEX_COLUMNS[1:]]


def _finish(agg: DataFrame, compat_std: bool) -> DataFrame:
    """Derived metrics; the resolution is read back from the id."""
    x = agg.selectExpr(f"{cell_res_sql('h3_index')} AS h3_res", "*")
    return x.selectExpr("h3_res", "h3_index", *metrics_sql(compat_std))


def build_index(
    df: DataFrame,
    resolutions=DEFAULT_RESOLUTIONS,
    lat: str = "lat",
    lon: str = "lon",
    area: str = "area_deg2",
    height: str = "height",
    compat_std: bool = False,
) -> DataFrame:
    """Footprints -> v2 index rows for every resolution, plus ``h3_res``.

    Input needs centroid ``lat``/``lon``, planar ``area_deg2`` and ``height``
    (sentinel -999 = none); see :func:`tessera.functions.measures.with_measures`.
    """
    # a row whose geometry could not be measured belongs to no cell
    rows = near_together(measurable(df, lat, lon, area).select(lat, lon, area, height), resolutions, lat, lon)
    x = with_building_metrics(rows, lat=lat, area=area, height=height, keep=[lat, lon])
    cells = _exploded_cells(x, resolutions, lat, lon)
    # The id carries the resolution, so the cell id alone is the key: the
    # output is hash-partitioned on h3_index and a later join or aggregate
    # on the cell reuses that partitioning instead of shuffling again.
    return _finish(cells.groupBy("h3_index").agg(*_sums()), compat_std)


def partials(
    df: DataFrame,
    resolutions=DEFAULT_RESOLUTIONS,
    tile_col: str = "tile_id",
    lat: str = "lat",
    lon: str = "lon",
    area: str = "area_deg2",
    height: str = "height",
) -> DataFrame:
    """Additive per-(resolution, tile, cell) sums, DOUBLE (no float32 loss).

    Cells without a valid height get height sums 0 and a NULL maximum
    (never NaN: NaN would win every later MAX).
    """
    rows = measurable(df, lat, lon, area).selectExpr(f"CAST({tile_col} AS STRING) AS tile_id", lat, lon, area, height)
    x = with_building_metrics(near_together(rows, resolutions, lat, lon), lat=lat, area=area, height=height, keep=["tile_id", lat, lon])
    cells = _exploded_cells(x, resolutions, lat, lon, keep=("tile_id",))
    agg = cells.groupBy("tile_id", "h3_index").agg(*_sums())
    return agg.selectExpr(
        f"{cell_res_sql('h3_index')} AS h3_res",
        "tile_id",
        "h3_index",
        "CAST(n AS INT) AS building_count",
        "fp AS total_footprint_m2",
        "hsum AS height_sum",
        "hsq AS height_sq_sum",
        "hmax AS max_height_m",
        "vol AS total_volume_m3",
        "CAST(hn AS INT) AS height_count",
    )


#: What names one version of a source file.
FILE_KEY = ("file_path", "file_size", "file_time")


def building_measures(scan: DataFrame, keep=()) -> DataFrame:
    """Per source row: FILE_KEY, ``keep``, lat, lon, ok, fp_m2, h. ``ok`` is false where the
    geometry cannot be measured."""
    ok = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ("lat", "lon", "area_deg2"))
    x = with_building_metrics(with_measures(scan).withColumn("ok", F.expr(ok)), keep=[*FILE_KEY, *keep, "lat", "lon", "ok"])
    return x.drop("vol")


def sum_partials(measures: DataFrame, resolutions=DEFAULT_RESOLUTIONS, todo: str | None = None) -> DataFrame:
    """Partial rows of :func:`building_measures`, see :func:`file_partials`."""
    resolutions = list(resolutions)
    x = with_cells(measures.selectExpr("*", "fp_m2 * h AS vol"), resolutions, prefix="__cell_")
    ids = ", ".join(f"named_struct('h3_res', {r}, 'h3_index', CASE WHEN ok THEN __cell_{r} END)" for r in resolutions)
    wanted = f"array({ids})" if todo is None else f"filter(array({ids}), c -> array_contains({todo}, c.h3_res))"
    cells = x.selectExpr(*FILE_KEY, f"inline({wanted})", "fp_m2", "CASE WHEN ok THEN h END AS h", "CASE WHEN ok THEN vol END AS vol")
    agg = cells.groupBy(*FILE_KEY, "h3_res", "h3_index").agg(*_sums())
    return agg.selectExpr(
        "h3_res",
        *FILE_KEY,
        "h3_index",
        "n AS building_count",
        "fp AS total_footprint_m2",
        "hsum AS height_sum",
        "hsq AS height_sq_sum",
        "hmax AS max_height_m",
        "vol AS total_volume_m3",
        "hn AS height_count",
    )


def file_partials(scan: DataFrame, resolutions=DEFAULT_RESOLUTIONS, todo: str | None = None) -> DataFrame:
    """Partial rows of source files, with the count of rejected rows.

    ``scan`` has FILE_KEY, geometry and height; ``todo`` may name a column
    with the resolutions wanted of the row's file. Rows whose geometry cannot be
    measured have no cell: they make one row for each file and resolution with a
    NULL h3_index, whose building_count is the number rejected. So one pass over
    the geometry gives both the sums and the counts.
    """
    return sum_partials(building_measures(scan, [todo] if todo else []), resolutions, todo)


FILE_PARTIALS_SCHEMA = (
    "h3_res int, file_path string, file_size long, file_time timestamp, h3_index long, building_count long, "
    "total_footprint_m2 double, height_sum double, height_sq_sum double, max_height_m double, "
    "total_volume_m3 double, height_count long"
)


def with_file_key(scan: DataFrame) -> DataFrame:
    """A file scan with FILE_KEY from its ``_metadata``."""
    return scan.withColumns({
        "file_path": F.col("_metadata.file_path"),
        "file_size": F.col("_metadata.file_size"),
        "file_time": F.col("_metadata.file_modification_time"),
    })


#: Sums of a cell, as partial and merged rows hold them.
SUM_COLUMNS = ("building_count", "total_footprint_m2", "height_sum", "height_sq_sum", "max_height_m", "total_volume_m3", "height_count")


def merge_sums(part: DataFrame, keys=("h3_index",)) -> DataFrame:
    """Partial rows of one cell added up; the result merges again with others."""
    return part.groupBy(*keys).agg(*[F.expr(f"{'max' if c == 'max_height_m' else 'sum'}({c}) AS {c}") for c in SUM_COLUMNS])


def index_of_sums(sums: DataFrame, compat_std: bool = False) -> DataFrame:
    """Final index rows of merged sums, one row per cell."""
    names = dict(zip(("building_count", "total_footprint_m2", "height_sum", "height_count", "height_sq_sum", "max_height_m", "total_volume_m3"), ("n", "fp", "hsum", "hn", "hsq", "hmax", "vol")))
    return _finish(sums.selectExpr("h3_index", *(f"{c} AS {n}" for c, n in names.items())), compat_std)


def merge_partials(part: DataFrame, compat_std: bool = False) -> DataFrame:
    """Merge partial rows of any disjoint split of the buildings into final index rows."""
    return index_of_sums(merge_sums(part), compat_std)


def cell_counts(idx: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct cells per resolution (``approx_count_distinct`` on request)."""
    agg = F.countDistinct("h3_index") if exact else F.approx_count_distinct("h3_index")
    return idx.groupBy("h3_res").agg(agg.cast("long").alias("n_cells"))


def index_res(idx: DataFrame, res: int) -> DataFrame:
    """The 11-column v2 table of one resolution."""
    return idx.where(f"h3_res = {res}").select(*INDEX_COLUMNS)
