"""Test inputs derived from the driver's TPC-H-like tables.

The driver tables hold no polygons, so building rows are derived from
``lineitem`` (one row = one rectangular building; every third one has a
hole), with region names through ``supplier -> nation``. Ordinates are
dyadic fractions, so closed-form area and centroid are exact in double
and the DuckDB oracle needs no geometry functions.

The formulas are SQL text that parses the same in Spark SQL and DuckDB:
the DataFrame path evaluates it with ``F.expr`` and the oracles embed the
very same text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.readers import spread

# --- fixed values: fixture formulas ----------------------------------------
BASE_COLUMNS = {
    "id": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), "
    "CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), "
    "CAST(CAST(l_quantity AS INT) AS STRING))",
    "source": "concat(l_returnflag, l_linestatus)",
    "region": "n_name",
    "lon": "((l_suppkey * 7919) % 5600) / 16.0e0 - 175 "
    "+ ((l_partkey * 31 + l_linenumber * 17) % 1024) / 4096.0e0 - 0.125e0",
    "lat": "((l_suppkey * 104729) % 1920) / 16.0e0 - 55 "
    "+ ((l_orderkey * 13 + l_partkey * 7) % 1024) / 4096.0e0 - 0.125e0",
    "hw": "(l_quantity + 7) / 1048576.0e0",
    "hh": "(58 - l_quantity) / 1048576.0e0",
    "has_hole": "(l_linenumber % 3 = 0)",
    "height": "CASE WHEN l_discount = 0 OR l_suppkey % 10 = 0 THEN -999.0e0 "
    "ELSE 2 + l_quantity / 4.0e0 END",
    "var": "l_discount",
    # split key used by the partial/merge tests (two interleaved "tiles")
    "half": "CAST(l_linenumber % 2 AS INT)",
}
DERIVED_COLUMNS = {
    "area_deg2": "4 * hw * hh * CASE WHEN has_hole THEN 0.75e0 ELSE 1.0e0 END",
    "tile_id": "concat(CAST(CAST(floor(lon / 5) AS INT) AS STRING), '_', "
    "CAST(CAST(floor(lat / 5) AS INT) AS STRING))",
}
JOIN_SQL = (
    "lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey"
)
FOOTPRINT_COLUMNS = ("id", "tile_id", "source", "region", "lon", "lat", "area_deg2", "height", "var", "half")


def footprints_sql() -> str:
    """The fixture as one SQL query over lineitem/supplier/nation."""
    base = ", ".join(f"{e} AS {k}" for k, e in BASE_COLUMNS.items())
    derived = ", ".join(f"{e} AS {k}" for k, e in DERIVED_COLUMNS.items())
    return f"SELECT *, {derived} FROM (SELECT {base} FROM {JOIN_SQL}) AS fx_base"


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_returnflag",
        "l_linestatus",
    )
    # one row group cannot be split: spread small inputs over the cores
    li = spread(li)
    su = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    na = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    return li, su, na


def footprint_base(spark: SparkSession, sf_dir: str, by_tile: bool = False) -> DataFrame:
    """lineitem -> building attributes before geometry (hw, hh, has_hole). ``by_tile``: in ranges of (tile_id, id)."""
    li, su, na = _tables(spark, sf_dir)
    # supplier and nation are dimension tables; the planner broadcasts them
    # when their (file-size) statistics are under the broadcast threshold.
    j = li.join(su, li.l_suppkey == su.s_suppkey).join(na, su.s_nationkey == na.n_nationkey)
    if by_tile:
        # the table's own columns are shuffled, which are narrower than what is made of them
        tile = re.sub(r"\b(lon|lat)\b", lambda m: f"({BASE_COLUMNS[m[1]]})", DERIVED_COLUMNS["tile_id"])
        j = j.drop("s_suppkey", "s_nationkey", "n_nationkey").repartitionByRange(F.expr(tile), F.expr(BASE_COLUMNS["id"]))
    return j.selectExpr(*[f"{e} AS {k}" for k, e in BASE_COLUMNS.items()])


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured footprints: id, tile_id, source, region, lon, lat, area_deg2, height, var."""
    b = footprint_base(spark, sf_dir)
    return b.selectExpr("*", *[f"{e} AS {k}" for k, e in DERIVED_COLUMNS.items()]).select(*FOOTPRINT_COLUMNS)


# ---------------------------------------------------------------------------
# WKB rectangles (with an optional concentric half-size hole)
# ---------------------------------------------------------------------------

_SHELL = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]  # counter-clockwise
_HOLE = [(-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5), (-0.5, -0.5)]  # clockwise


def rect_wkb_arrays(lon, lat, hw, hh, hole) -> pa.Array:
    """Little-endian WKB polygons for whole columns at once (NumPy)."""
    lon, lat, hw, hh = (np.asarray(a, dtype=np.float64) for a in (lon, lat, hw, hh))
    hole = np.asarray(hole, dtype=bool)
    n = len(lon)
    plain = np.dtype([("bo", "u1"), ("t", "<u4"), ("nr", "<u4"), ("np", "<u4"), ("xy", "<f8", (10,))])
    holed = np.dtype(plain.descr + [("np2", "<u4"), ("xy2", "<f8", (10,))])
    lens = np.where(hole, holed.itemsize, plain.itemsize).astype(np.int64)
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(lens, out=offsets[1:])
    data = np.empty(int(offsets[-1]), dtype=np.uint8)
    for mask, dt in ((~hole, plain), (hole, holed)):
        rows = np.nonzero(mask)[0]
        if not len(rows):
            continue
        rec = np.zeros(len(rows), dtype=dt)
        rec["bo"] = 1
        rec["t"] = 3
        rec["nr"] = 2 if dt is holed else 1
        rec["np"] = 5
        x, y, w, h = lon[rows, None], lat[rows, None], hw[rows, None], hh[rows, None]
        sx = np.array([p[0] for p in _SHELL])
        sy = np.array([p[1] for p in _SHELL])
        rec["xy"][:, 0::2] = x + sx * w
        rec["xy"][:, 1::2] = y + sy * h
        if dt is holed:
            hx = np.array([p[0] for p in _HOLE])
            hy = np.array([p[1] for p in _HOLE])
            rec["np2"] = 5
            rec["xy2"][:, 0::2] = x + hx * w
            rec["xy2"][:, 1::2] = y + hy * h
        raw = rec.view(np.uint8).reshape(len(rows), dt.itemsize)
        data[offsets[rows][:, None] + np.arange(dt.itemsize)] = raw
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _wkb_batch(lon: pa.Array, lat: pa.Array, hw: pa.Array, hh: pa.Array, hole: pa.Array) -> pa.Array:
    return rect_wkb_arrays(
        lon.to_numpy(zero_copy_only=False),
        lat.to_numpy(zero_copy_only=False),
        hw.to_numpy(zero_copy_only=False),
        hh.to_numpy(zero_copy_only=False),
        hole.to_numpy(zero_copy_only=False),
    )


rect_wkb = F.arrow_udf(_wkb_batch, T.BinaryType())


def buildings(spark: SparkSession, sf_dir: str, by_tile: bool = False) -> DataFrame:
    """Source-tile rows: id, source, region, height FLOAT, var FLOAT, geometry WKB.

    ``tile_id`` is kept so tiles can be written, in ranges of (tile_id, id) with ``by_tile``; ``half`` for split tests.
    """
    b = footprint_base(spark, sf_dir, by_tile)
    return b.select(
        "id",
        "source",
        "region",
        F.col("height").cast("float").alias("height"),
        F.col("var").cast("float").alias("var"),
        rect_wkb("lon", "lat", "hw", "hh", "has_hole").alias("geometry"),
        F.expr(DERIVED_COLUMNS["tile_id"]).alias("tile_id"),
        "half",
    )


def population(index_res5: DataFrame) -> DataFrame:
    """Side table keyed by cell: pop_2025 = (cell % 997) * 50, some cells dropped."""
    return index_res5.select(
        "h3_index", ((F.col("h3_index") % 997) * 50.0).alias("pop_2025")
    ).where(F.col("h3_index") % 5 != 0)


POPULATION_SQL = (
    "SELECT h3_index, (h3_index % 997) * 50.0e0 AS pop_2025 FROM idx5 WHERE h3_index % 5 <> 0"
)
