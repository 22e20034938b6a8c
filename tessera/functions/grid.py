"""Equal-area hexagonal cell grid as pure Column expressions.

Cells tile a cylindrical equal-area projection of the sphere
(``u`` = scaled longitude, ``v`` = scaled sine of latitude) with rows of
pointy-top hexagons. Every cell of one resolution has the same area; the
mean cell area per resolution follows the usual ``2 + 120*7^r`` cell-count
rule of hexagonal global grids.

A cell id packs ``res << 52 | row << 26 | col`` into a positive BIGINT. Ids
sort by (resolution, row, column) and rows grow with latitude, so a
latitude band is one contiguous id range (row-group pruning on sorted
output, see :func:`lat_band_id_range`).

Everything is built from built-in functions, so it stays inside whole-stage
codegen. The formulas are written once against :mod:`tessera.functions.dual`
so the DuckDB oracle evaluates exactly the same operations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import dual as D

# --- fixed values -----------------------------------------------------------
EARTH_RADIUS_KM = 6371.0072
MAX_RES = 15
RES_SHIFT = 52
ROW_SHIFT = 26
FIELD_MASK = (1 << ROW_SHIFT) - 1
DEG2RAD = 0.017453292519943295
RAD2DEG = 57.29577951308232


@dataclass(frozen=True)
class GridSpec:
    res: int
    n: int  # hexagon columns around the globe
    m: int  # hexagon rows pole to pole
    area_km2: float  # exact area of every cell


def grid_spec(res: int) -> GridSpec:
    if not 0 <= res <= MAX_RES:
        raise ValueError(f"resolution {res} outside 0..{MAX_RES}")
    r = EARTH_RADIUS_KM
    sphere = 4.0 * math.pi * r * r
    mean_area = sphere / (2 + 120 * 7**res)
    width = math.sqrt(2.0 * mean_area / math.sqrt(3.0))
    n = round(2.0 * math.pi * r / width)
    m = round(2.0 * r / (width * math.sqrt(3.0) / 2.0))
    return GridSpec(res, n, m, sphere / (n * m))


SPECS = tuple(grid_spec(r) for r in range(MAX_RES + 1))


# ---------------------------------------------------------------------------
# point -> cell
# ---------------------------------------------------------------------------


def _formula(lat, lon, res: int, bind):
    """Cell id of (lat, lon) at ``res``.

    ``lat``/``lon`` are Columns or :class:`dual.Sql`. ``bind`` receives each
    stage as a dict name -> expression and returns references to use from
    then on: the expressions themselves (inline) or fresh columns (staged).
    """
    s = SPECS[res]
    u, v = bind({"u": (lon + 180.0) / 360.0 * s.n, "v": (D.sin(lat * DEG2RAD) + 1.0) / 2.0 * s.m})
    q, sc = bind({"q": u - v / 2.0, "s": -(u - v / 2.0) - v})
    qi, ri, si, dq, dr, ds = bind(
        {
            "qi": D.floor(q + 0.5),
            "ri": D.floor(v + 0.5),
            "si": D.floor(sc + 0.5),
            "dq": D.abs_(D.floor(q + 0.5) - q),
            "dr": D.abs_(D.floor(v + 0.5) - v),
            "ds": D.abs_(D.floor(sc + 0.5) - sc),
        }
    )
    # cube rounding: recompute the coordinate with the largest rounding error
    q_big = (dq > dr) & (dq > ds)
    q2, r2 = bind(
        {
            "q2": D.case((q_big, -ri - si), otherwise=qi),
            "r2": D.case((q_big, ri), (dr > ds, -qi - si), otherwise=ri),
        }
    )
    c = q2 + D.floor(r2 / 2.0)  # axial -> offset column
    wrapped = c - s.n * D.floor(c / s.n)
    return D.cast(r2, "BIGINT") * (1 << ROW_SHIFT) + D.cast(wrapped, "BIGINT") + (res << RES_SHIFT)


def _inline(d: dict):
    return tuple(d.values())


def cell_sql(lat: str, lon: str, res: int) -> str:
    """Cell id as one SQL expression (oracles, ad-hoc SQL)."""
    return _formula(D.Sql(lat), D.Sql(lon), res, _inline).t


def cell_of(lat: Column | str, lon: Column | str, res: int) -> Column:
    """Cell id of a point at resolution ``res`` as one Column.

    Codegen's common-subexpression elimination evaluates the shared parts
    once per row. For several resolutions over a big frame use
    :func:`with_cells`, which stages the work as plain projections.
    """
    if isinstance(lat, str) and isinstance(lon, str):
        return F.expr(cell_sql(lat, lon, res))  # one JVM call for the whole formula
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    # Expression inputs are bound once (a lambda variable) instead of being
    # copied into every use inside the formula, which would blow up the plan.
    arr = F.array(F.struct(lat_c.cast("double").alias("lat"), lon_c.cast("double").alias("lon")))
    return F.element_at(F.transform(arr, lambda x: _formula(x["lat"], x["lon"], res, _inline)), 1)


def with_cells(
    df: DataFrame,
    resolutions,
    lat: str = "lat",
    lon: str = "lon",
    prefix: str = "cell_",
) -> DataFrame:
    """Add a BIGINT cell-id column ``{prefix}{res}`` per resolution.

    One projection, sent as SQL text in one call: building the formula
    operator by operator costs one driver-JVM round trip per operator.
    Codegen's common-subexpression elimination evaluates the repeated
    parts of the formula once per row.
    """
    return df.selectExpr("*", *[f"{cell_sql(lat, lon, r)} AS {prefix}{r}" for r in resolutions])


# ---------------------------------------------------------------------------
# cell -> properties
# ---------------------------------------------------------------------------


def _name(cell) -> str:
    if not isinstance(cell, str):
        raise TypeError("pass the cell column by name")
    return cell


def _shr(cell: str, k: int, spark: bool) -> str:
    # Spark's parser can mistake ">>" for a type bracket after array(...)
    return f"shiftright({cell}, {k})" if spark else f"({cell} >> {k})"


def _res_sql(cell: str, spark: bool = True) -> str:
    return f"CAST(({_shr(cell, RES_SHIFT, spark)} & 15) AS INT)"


def _row_sql(cell: str, spark: bool = True) -> str:
    return f"({_shr(cell, ROW_SHIFT, spark)} & {FIELD_MASK})"


def _col_sql(cell: str) -> str:
    return f"({cell} & {FIELD_MASK})"


def _per_res_sql(cell: str, values) -> str:
    arr = ", ".join(D._lit_sql(float(v)) for v in values)
    return f"element_at(array({arr}), {_res_sql(cell)} + 1)"


def _lat_formula(r, m):
    return D.asin(2.0 * r / m - 1.0) * RAD2DEG


def _lon_formula(r, c, n, parity):
    return (c + parity / 2.0) / n * 360.0 - 180.0


def cell_res_sql(cell: str) -> str:
    return _res_sql(cell)


def cell_lat_any_sql(cell: str) -> str:
    """Centre latitude for ids of any resolution (Spark SQL text)."""
    return _lat_formula(D.Sql(_row_sql(cell)), D.Sql(_per_res_sql(cell, [s.m for s in SPECS]))).t


def cell_lon_any_sql(cell: str) -> str:
    r = D.Sql(_row_sql(cell))
    n = D.Sql(_per_res_sql(cell, [s.n for s in SPECS]))
    return _lon_formula(r, D.Sql(_col_sql(cell)), n, D.Sql(f"({r.t} % 2)")).t


def cell_area_any_sql(cell: str) -> str:
    return _per_res_sql(cell, [s.area_km2 for s in SPECS])


def cell_res(cell: str) -> Column:
    """Resolution stored in bits 52..55 of the id (also where H3 keeps it)."""
    return F.expr(_res_sql(_name(cell)))


def cell_lat(cell: str) -> Column:
    """Latitude of the cell centre (degrees, DOUBLE)."""
    return F.expr(cell_lat_any_sql(_name(cell)))


def cell_lon(cell: str) -> Column:
    """Longitude of the cell centre in [-180, 180) (degrees, DOUBLE)."""
    return F.expr(cell_lon_any_sql(_name(cell)))


def cell_area_km2(cell: str) -> Column:
    """Area of the cell; one constant per resolution (equal-area grid)."""
    return F.expr(cell_area_any_sql(_name(cell)))


def cell_to_hex(cell: str) -> Column:
    return F.expr(f"lower(hex({_name(cell)}))")


def hex_to_cell(s: str) -> Column:
    return F.expr(f"CAST(conv({s}, 16, 10) AS BIGINT)")


# vertex offsets of a cell in (u, v) units, clockwise from the top
BOUNDARY_OFFSETS = ((0.0, 2 / 3), (0.5, 1 / 3), (0.5, -1 / 3), (0.0, -2 / 3), (-0.5, -1 / 3), (-0.5, 1 / 3))


def _vertex_sql(r: str, c: str, n: str, m: str, du: float, dv: float) -> tuple[str, str]:
    uc = f"({c} + ({r} % 2) / 2.0e0)"
    v = f"least(greatest({r} + {D._lit_sql(dv)}, 0.0e0), {m})"
    lon = f"(({uc} + {D._lit_sql(du)}) / {n} * 360.0e0 - 180.0e0)"
    lon = f"(CASE WHEN {lon} >= 180.0e0 THEN {lon} - 360.0e0 WHEN {lon} < -180.0e0 THEN {lon} + 360.0e0 ELSE {lon} END)"
    lat = f"(asin(2.0e0 * {v} / {m} - 1.0e0) * {D._lit_sql(RAD2DEG)})"
    return lon, lat


def cell_boundary(cell: str) -> Column:
    """Six boundary vertices as ``array<struct<lon:double, lat:double>>``.

    In (u, v) units a cell is the hexagon around (col + parity/2, row) with
    vertices at v +- 2/3 and (u +- 1/2, v +- 1/3); rows are clipped to the
    poles, longitudes wrapped to [-180, 180).
    """
    c = _name(cell)
    n = _per_res_sql(c, [s.n for s in SPECS])
    m = _per_res_sql(c, [s.m for s in SPECS])
    pts = []
    for du, dv in BOUNDARY_OFFSETS:
        lon, lat = _vertex_sql(_row_sql(c), _col_sql(c), n, m, du, dv)
        pts.append(f"named_struct('lon', {lon}, 'lat', {lat})")
    return F.expr("array(" + ", ".join(pts) + ")")


def cell_boundary_sql(cell: str, res: int, k: int) -> tuple[str, str]:
    """(lon, lat) SQL of vertex ``k`` for ids of a known resolution (oracles)."""
    s = SPECS[res]
    du, dv = BOUNDARY_OFFSETS[k]
    return _vertex_sql(_row_sql(cell, spark=False), _col_sql(cell), D._lit_sql(float(s.n)), D._lit_sql(float(s.m)), du, dv)


def lat_band_id_range(res: int, lat_lo: float, lat_hi: float) -> tuple[int, int]:
    """Smallest id range holding every cell whose centre lies in the band.

    Row of a point is within one of ``(sin(lat)+1)/2*m``; pad one row each
    side. Used to add a pushed-down ``h3_index BETWEEN`` to bbox filters.
    """
    s = SPECS[res]

    def row(lat):
        return (math.sin(math.radians(lat)) + 1.0) / 2.0 * s.m

    lo = max(0, math.floor(row(lat_lo)) - 1)
    hi = min(s.m, math.ceil(row(lat_hi)) + 1)
    base = res << RES_SHIFT
    return base + (lo << ROW_SHIFT), base + (hi << ROW_SHIFT) + FIELD_MASK


# --- SQL-text counterparts (oracles) ---------------------------------------


def cell_lat_sql(cell: str, res: int) -> str:
    """Centre latitude for ids of a known resolution (both engines)."""
    s = SPECS[res]
    return _lat_formula(D.Sql(_row_sql(cell, spark=False)), float(s.m)).t


def cell_lon_sql(cell: str, res: int) -> str:
    s = SPECS[res]
    r = D.Sql(_row_sql(cell, spark=False))
    return _lon_formula(r, D.Sql(_col_sql(cell)), float(s.n), D.Sql(f"({r.t} % 2)")).t
