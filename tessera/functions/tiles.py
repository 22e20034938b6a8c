"""Map-tile helpers: snap grid, Web-Mercator quadkeys, continents, bbox.

All pure Column expressions (JVM codegen), written against
:mod:`tessera.functions.dual` where an oracle needs the same arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import CONTINENT_BOXES, CONTINENT_OTHER, MERCATOR_MAX_LAT
from tessera.functions import dual as D
from tessera.functions.grid import DEG2RAD, lat_band_id_range

PI = math.pi


def snap_precision(z: int) -> float:
    """Snap-grid spacing in degrees at zoom ``z``: 360 / 2^z."""
    return 360.0 / (2**z)


def snap_coord(x, z: int):
    """Index of the nearest multiple of the zoom's spacing (both axes alike)."""
    return D.floor(x / snap_precision(z) + 0.5)


def snap_cell(lon, lat, z: int):
    """(snap_x, snap_y) grid indices of a point at zoom ``z``.

    Column names (str) give Columns built from SQL text in one call each.
    """
    if isinstance(lon, str):
        return F.expr(snap_coord(D.Sql(lon), z).t), F.expr(snap_coord(D.Sql(lat), z).t)
    return snap_coord(lon, z), snap_coord(lat, z)


def _clamp(x, lo, hi):
    return D.least(D.greatest(x, lo), hi)


def tile_xy(lon, lat, z: int):
    """Web-Mercator tile column/row at zoom ``z`` (latitude clamped)."""
    n = float(2**z)
    la = _clamp(lat, -MERCATOR_MAX_LAT, MERCATOR_MAX_LAT) * DEG2RAD
    x = D.floor((lon + 180.0) / 360.0 * n)
    y = D.floor((1.0 - D.ln(D.tan(la) + 1.0 / D.cos(la)) / PI) / 2.0 * n)
    top = 2**z - 1
    return _clamp(x, 0, top), _clamp(y, 0, top)


_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def _spread_sql(v: str) -> str:
    """Insert a zero bit between the bits of a value below 2^31 (SQL text)."""
    for shift, mask in _SPREAD:
        v = f"((shiftleft({v}, {shift}) | {v}) & {mask})"
    return v


def quadkey_spark_sql(lon: str, lat: str, z: int) -> str:
    """Quadkey as Spark SQL text: bit-interleave x and y into one base-4
    number, ``conv`` it to base 4 and left-pad to ``z`` digits."""
    if not 0 <= z <= 30:
        raise ValueError("zoom must be in 0..30")
    if z == 0:
        return "''"
    x, y = tile_xy(D.Sql(lon), D.Sql(lat), z)
    code = f"({_spread_sql(f'CAST({y.t} AS BIGINT)')} * 2 + {_spread_sql(f'CAST({x.t} AS BIGINT)')})"
    return f"lpad(conv(CAST({code} AS STRING), 10, 4), {z}, '0')"


def quadkey(lon: str, lat: str, z: int) -> Column:
    """Quadkey string of a point at zoom ``z`` (digit = 2*ybit + xbit)."""
    return F.expr(quadkey_spark_sql(lon, lat, z))


def with_quadkey_code(df: DataFrame, lon: str, lat: str, z: int, name: str = "quadkey_code") -> DataFrame:
    """Add the quadkey as a number, in the same order; tile x/y are materialised first so the bit
    interleave refers to two plain columns."""
    x, y = tile_xy(D.Sql(lon), D.Sql(lat), z)
    t = df.selectExpr("*", f"CAST({x.t} AS BIGINT) AS __qk_x", f"CAST({y.t} AS BIGINT) AS __qk_y")
    code = f"({_spread_sql('__qk_y')} * 2 + {_spread_sql('__qk_x')})"
    return t.selectExpr("*", f"{code} AS {name}").drop("__qk_x", "__qk_y")


def quadkey_of_code(code: str, z: int) -> Column:
    """Quadkey string of its number."""
    return F.expr(f"lpad(conv(CAST({code} AS STRING), 10, 4), {z}, '0')" if z else "''")


def with_quadkey(df: DataFrame, lon: str, lat: str, z: int, name: str = "quadkey") -> DataFrame:
    """Add the quadkey column."""
    t = with_quadkey_code(df, lon, lat, z, "__qk")
    return t.withColumn(name, quadkey_of_code("__qk", z)).drop("__qk")


def quadkey_sql(lon: str, lat: str, z: int) -> str:
    """Quadkey as SQL text (digit by digit), for oracles."""
    x, y = tile_xy(D.Sql(lon), D.Sql(lat), z)
    xi, yi = f"CAST({x.t} AS BIGINT)", f"CAST({y.t} AS BIGINT)"
    digits = [
        f"CAST(((({yi}) >> {i}) & 1) * 2 + ((({xi}) >> {i}) & 1) AS VARCHAR)" for i in range(z - 1, -1, -1)
    ]
    return "concat(" + ", ".join(digits) + ")" if digits else "''"


def in_quad(df: DataFrame, prefix: str, col: str = "quadkey") -> DataFrame:
    """Rows whose quadkey starts with ``prefix`` (pushed to Parquet as StartsWith)."""
    return df.where(F.col(col).startswith(prefix))


def continent_col(lat_sql: str, lon_sql: str) -> Column:
    """:func:`continent` over SQL text inputs, as one Column."""
    return F.expr(continent(D.Sql(lat_sql), D.Sql(lon_sql)).t)


def continent(lat, lon):
    """Continent by ordered bounding boxes (boxes overlap: first match wins)."""
    branches = []
    for name, la0, la1, lo0, lo1 in CONTINENT_BOXES:
        if D.is_sql(lat):
            cond = D.Sql(f"({lat.t} BETWEEN {la0} AND {la1} AND {lon.t} BETWEEN {lo0} AND {lo1})")
            branches.append((cond, D.Sql(f"'{name}'")))
        else:
            cond = lat.between(la0, la1) & lon.between(lo0, lo1)
            branches.append((cond, F.lit(name)))
    other = D.Sql(f"'{CONTINENT_OTHER}'") if D.is_sql(lat) else F.lit(CONTINENT_OTHER)
    return D.case(*branches, otherwise=other)


def bbox(idx: DataFrame, lat0: float, lat1: float, lon0: float, lon1: float, res: int | None = None,
         lat: str | None = None, lon: str | None = None) -> DataFrame:
    """Cells whose centre lies in the box.

    Centre lat/lon are derived from the id, which Parquet cannot filter on;
    when ``res`` is known an extra ``h3_index BETWEEN lo AND hi`` (the
    latitude band's id range) is added, which *is* pushed to the scan and
    skips row groups of an index sorted by id.
    """
    from tessera.functions.grid import cell_lat_any_sql, cell_lon_any_sql

    la = lat or cell_lat_any_sql("h3_index")
    lo = lon or cell_lon_any_sql("h3_index")
    out = idx
    if res is not None:
        a, b = lat_band_id_range(res, lat0, lat1)
        out = out.where(f"h3_index BETWEEN {a} AND {b}")
    return out.where(f"({la}) BETWEEN {lat0} AND {lat1} AND ({lo}) BETWEEN {lon0} AND {lon1}")
