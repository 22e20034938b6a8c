"""Footprint measures: centroid and planar area from WKB, m2, volume.

``with_measures`` is the only Python on the hot path: one Arrow UDF that
works on whole record batches. Simple little-endian polygons (the common
case) are grouped by byte length and measured as one ``(k, points, 2)``
float block with NumPy; anything else (holes, multipolygons, big-endian,
points) takes a per-geometry walk. Unreadable, empty or NULL geometry
yields NULL measures, which :func:`tessera.operators.validate.split_valid`
quarantines.

Everything after the centroid/area is plain Column arithmetic.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.constants import DEG_TO_M
from tessera.functions import dual as D
from tessera.functions.grid import DEG2RAD

MEASURE_TYPE = T.StructType(
    [
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("area_deg2", T.DoubleType()),
    ]
)

# WKB geometry type codes (ISO numbering; EWKB flag bits are masked off).
WKB_POINT, WKB_LINESTRING, WKB_POLYGON = 1, 2, 3
WKB_MULTIPOINT, WKB_MULTILINESTRING, WKB_MULTIPOLYGON, WKB_COLLECTION = 4, 5, 6, 7
GEOMETRY_TYPE_NAMES = {
    1: "POINT",
    2: "LINESTRING",
    3: "POLYGON",
    4: "MULTIPOINT",
    5: "MULTILINESTRING",
    6: "MULTIPOLYGON",
    7: "GEOMETRYCOLLECTION",
}


# ---------------------------------------------------------------------------
# WKB walking (per geometry, fallback path)
# ---------------------------------------------------------------------------


class CutShort(ValueError):
    """Fewer bytes than the geometry announces."""


class _Reader:
    __slots__ = ("b", "pos", "end")

    def __init__(self, b: bytes):
        self.b, self.pos, self.end = b, 0, len(b)

    def u8(self) -> int:
        if self.pos + 1 > self.end:
            raise CutShort
        v = self.b[self.pos]
        self.pos += 1
        return v

    def u32(self, le: bool) -> int:
        if self.pos + 4 > self.end:
            raise CutShort
        v = int.from_bytes(self.b[self.pos : self.pos + 4], "little" if le else "big")
        self.pos += 4
        return v

    def coords(self, n: int, le: bool, dims: int) -> np.ndarray:
        nbytes = 8 * dims * n
        if self.pos + nbytes > self.end:
            raise CutShort
        a = np.frombuffer(self.b, dtype="<f8" if le else ">f8", count=dims * n, offset=self.pos)
        self.pos += nbytes
        return a.reshape(n, dims)[:, :2].astype(np.float64)


def _type_and_dims(code: int) -> tuple[int, int, bool]:
    has_srid = bool(code & 0x20000000)
    dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    base = code % 1000
    iso = code // 1000
    if iso:
        dims = {1: 3, 2: 3, 3: 4}.get(iso, 2)
    return base, dims, has_srid


def _ring_terms(xy: np.ndarray, ox: float, oy: float) -> tuple[float, float, float]:
    """Shoelace sums over one ring relative to the origin (ox, oy).

    Returns (2*signed area, sum (x0+x1)*cross, sum (y0+y1)*cross).
    Translating first keeps the digits: at 100 degree coordinates and
    1e-5 degree sides an untranslated shoelace keeps ~3 digits.
    """
    x = xy[:, 0] - ox
    y = xy[:, 1] - oy
    x0, x1, y0, y1 = x[:-1], x[1:], y[:-1], y[1:]
    cross = x0 * y1 - x1 * y0
    return float(cross.sum()), float(((x0 + x1) * cross).sum()), float(((y0 + y1) * cross).sum())


def _add_line(xy: np.ndarray, acc: dict) -> None:
    """Length and length-weighted midpoints of a line; its points count where it has no length."""
    if len(xy) == 0:
        return
    acc["pts"].extend(xy)
    d = np.hypot(*np.diff(xy, axis=0).T) if len(xy) > 1 else np.zeros(0)
    acc["length"] += float(d.sum())
    if len(d):
        mid = (xy[:-1] + xy[1:]) / 2.0
        acc["lx"] += float((d * mid[:, 0]).sum())
        acc["ly"] += float((d * mid[:, 1]).sum())


def _walk(r: _Reader, acc: dict) -> None:
    le = r.u8() == 1
    base, dims, has_srid = _type_and_dims(r.u32(le))
    if has_srid:
        r.u32(le)
    if base == WKB_POINT:
        xy = r.coords(1, le, dims)
        if not np.isnan(xy).any():
            acc["pts"].append(xy[0])
    elif base == WKB_LINESTRING:
        xy = r.coords(r.u32(le), le, dims)
        _add_line(xy, acc)
    elif base == WKB_POLYGON:
        nrings = r.u32(le)
        for i in range(nrings):
            xy = r.coords(r.u32(le), le, dims)
            if len(xy) == 0:
                continue
            if acc["origin"] is None:
                acc["origin"] = (float(xy[0, 0]), float(xy[0, 1]))
            ox, oy = acc["origin"]
            a2, sx, sy = _ring_terms(xy, ox, oy)
            w = 1.0 if i == 0 else -1.0  # shell adds, holes subtract
            sgn = 1.0 if a2 >= 0 else -1.0
            acc["area2"] += w * abs(a2)
            acc["sx"] += w * sgn * sx
            acc["sy"] += w * sgn * sy
            _add_line(xy, acc)
    elif base in (WKB_MULTIPOINT, WKB_MULTILINESTRING, WKB_MULTIPOLYGON, WKB_COLLECTION):
        for _ in range(r.u32(le)):
            _walk(r, acc)
    else:
        raise ValueError(f"unsupported WKB type {base}")


def measure_one(b: bytes | None) -> tuple[float, float, float] | None:
    """(lon, lat, area_deg2) of one WKB geometry, or None if unreadable/empty."""
    if b is None or len(b) < 5:
        return None
    acc = {"area2": 0.0, "sx": 0.0, "sy": 0.0, "origin": None, "length": 0.0, "lx": 0.0, "ly": 0.0, "pts": []}
    try:
        r = _Reader(bytes(b))
        _walk(r, acc)
    except (ValueError, IndexError, struct.error):
        return None
    if acc["area2"] > 0.0:
        ox, oy = acc["origin"]
        a = acc["area2"] / 2.0
        return ox + acc["sx"] / (6.0 * a), oy + acc["sy"] / (6.0 * a), a
    if acc["length"] > 0.0:
        # lines and shapes of no area: segments weigh by their length
        return acc["lx"] / acc["length"], acc["ly"] / acc["length"], 0.0
    if acc["pts"]:
        # points and shapes of no length: the mean of the vertices
        p = np.asarray(acc["pts"], dtype=np.float64)
        return float(p[:, 0].mean()), float(p[:, 1].mean()), 0.0
    return None


def reason_of(b: bytes | None) -> str | None:
    """Why a geometry cannot be measured, see :func:`reject_reason`."""
    if not b:
        return "missing"
    acc = {"area2": 0.0, "sx": 0.0, "sy": 0.0, "origin": None, "length": 0.0, "lx": 0.0, "ly": 0.0, "pts": []}
    try:
        _walk(_Reader(bytes(b)), acc)
    except CutShort:
        return "cut_short"
    except (ValueError, IndexError, struct.error):
        return "unknown_type"
    if not acc["pts"]:
        return "no_vertices"
    m = measure_one(b)
    return "not_finite" if m is None or np.isnan(m).any() else None


# ---------------------------------------------------------------------------
# batch path
# ---------------------------------------------------------------------------


def _u32(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Little-endian uint32 at byte positions ``pos`` (vectorised)."""
    b = data[pos[:, None] + np.arange(4)].astype(np.int64)
    return b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16) | (b[:, 3] << 24)


def _f64_at(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Little-endian doubles at arbitrary byte positions, via eight float64
    views of the buffer shifted by 0..7 bytes (no per-byte gather)."""
    out = np.empty(len(pos))
    rem = pos & 7
    for k in range(8):
        m = rem == k
        if m.any():
            view = np.frombuffer(data, dtype="<f8", offset=k, count=(len(data) - k) // 8)
            out[m] = view[(pos[m] - k) >> 3]
    return out


def _polygons_le(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, multi: np.ndarray, out) -> np.ndarray:
    """Measure little-endian POLYGON and MULTIPOLYGON rows at once.

    Headers are walked one part or ring at a time across all rows;
    vertices of all rings are then gathered into one (V, 2) block and the
    shoelace sums reduced per ring with ``bincount``. Returns a mask of
    rows measured here; the rest go to the per-geometry walk.
    """
    lon, lat, area = out
    k = len(starts)
    ends = starts + lens
    ok = np.ones(k, dtype=bool)
    parts = np.where(multi, _u32(data, starts + 5), 1)
    pos = np.where(multi, starts + 9, starts)
    rings = np.zeros(k, dtype=np.int64)
    shell_next = np.zeros(k, dtype=bool)
    ring_row, ring_k, ring_start, ring_n = [], [], [], []
    while True:
        # rows between two parts: the next polygon's header
        act = np.nonzero(ok & (rings == 0) & (parts > 0))[0]
        short = pos[act] + 9 > ends[act]
        ok[act[short]] = False
        act = act[~short]
        other = (data[pos[act]] != 1) | (_u32(data, pos[act] + 1) != WKB_POLYGON) if len(act) else short[:0]
        ok[act[other]] = False
        act = act[~other]
        if len(act):
            rings[act] = _u32(data, pos[act] + 5)
            parts[act] -= 1
            pos[act] += 9
            shell_next[act] = True
        # rows within a part: the next ring
        act = np.nonzero(ok & (rings > 0))[0]
        if not len(act):
            if not (ok & (parts > 0)).any():
                break
            continue
        short = pos[act] + 4 > ends[act]
        ok[act[short]] = False
        act = act[~short]
        if not len(act):
            continue
        n = _u32(data, pos[act])
        nxt = pos[act] + 4 + 16 * n
        bad = nxt > ends[act]
        ok[act[bad]] = False
        act, n, nxt = act[~bad], n[~bad], nxt[~bad]
        ring_row.append(act)
        ring_k.append(np.where(shell_next[act], 0, 1))
        ring_start.append(pos[act] + 4)
        ring_n.append(n)
        pos[act] = nxt
        rings[act] -= 1
        shell_next[act] = False
    ok &= pos == ends
    if not ring_row:
        return np.zeros(k, dtype=bool)
    rr = np.concatenate(ring_row)
    rk = np.concatenate(ring_k)
    rs = np.concatenate(ring_start)
    rn = np.concatenate(ring_n)
    keep = ok[rr] & (rn > 0)
    rr, rk, rs, rn = rr[keep], rk[keep], rs[keep], rn[keep]
    if not len(rr):
        return np.zeros(k, dtype=bool)
    # one (V, 2) block of all vertices
    v_ring = np.repeat(np.arange(len(rr)), rn)
    first = np.repeat(np.cumsum(rn) - rn, rn)
    voff = np.repeat(rs, rn) + 16 * (np.arange(len(v_ring)) - first)
    xy = np.stack([_f64_at(data, voff), _f64_at(data, voff + 8)], axis=1)
    # origin: first vertex of each row's first ring
    ox = np.zeros(k)
    oy = np.zeros(k)
    at = (np.cumsum(rn) - rn)[::-1]  # reversed, so that the first ring is written last
    ox[rr[::-1]], oy[rr[::-1]] = xy[at, 0], xy[at, 1]
    x = xy[:, 0] - ox[rr[v_ring]]
    y = xy[:, 1] - oy[rr[v_ring]]
    same = v_ring[:-1] == v_ring[1:]
    x0, x1, y0, y1 = x[:-1][same], x[1:][same], y[:-1][same], y[1:][same]
    cross = x0 * y1 - x1 * y0
    seg_ring = v_ring[:-1][same]
    nring = len(rr)
    a2 = np.bincount(seg_ring, weights=cross, minlength=nring)
    sx = np.bincount(seg_ring, weights=(x0 + x1) * cross, minlength=nring)
    sy = np.bincount(seg_ring, weights=(y0 + y1) * cross, minlength=nring)
    w = np.where(rk == 0, 1.0, -1.0)  # shell adds, holes subtract
    sgn = np.where(a2 >= 0, 1.0, -1.0)
    area2 = np.bincount(rr, weights=w * np.abs(a2), minlength=k)
    msx = np.bincount(rr, weights=w * sgn * sx, minlength=k)
    msy = np.bincount(rr, weights=w * sgn * sy, minlength=k)
    done = ok & (area2 > 0)
    idx = np.nonzero(done)[0]
    lon[idx] = ox[idx] + msx[idx] / (3.0 * area2[idx])
    lat[idx] = oy[idx] + msy[idx] / (3.0 * area2[idx])
    area[idx] = area2[idx] / 2.0
    return done


def measure_arrays(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Measure a whole Arrow binary array; returns lon, lat, area, valid."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    off_dtype = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
    n = len(arr)
    lon = np.full(n, np.nan)
    lat = np.full(n, np.nan)
    area = np.full(n, np.nan)
    ok = np.zeros(n, dtype=bool)
    if n == 0:
        return lon, lat, area, ok
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=off_dtype, count=n + 1, offset=arr.offset * np.dtype(off_dtype).itemsize)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    valid = ~np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    starts = offsets[:-1].astype(np.int64)
    lens = (offsets[1:] - offsets[:-1]).astype(np.int64)

    # Vectorised path: little-endian plain POLYGON and MULTIPOLYGON, any rings.
    cand = np.nonzero(valid & (lens >= 13))[0]
    if len(cand):
        s = starts[cand]
        kind = _u32(data, s + 1)
        is_poly = (data[s] == 1) & ((kind == WKB_POLYGON) | (kind == WKB_MULTIPOLYGON))
        rows = cand[is_poly]
        if len(rows):
            sub = (np.full(len(rows), np.nan), np.full(len(rows), np.nan), np.full(len(rows), np.nan))
            done = _polygons_le(data, starts[rows], lens[rows], kind[is_poly] == WKB_MULTIPOLYGON, sub)
            hit = rows[done]
            lon[hit], lat[hit], area[hit] = sub[0][done], sub[1][done], sub[2][done]
            ok[hit] = True
    # Everything else (big-endian, points, lines, zero area): walk.
    slow = np.nonzero(valid & ~ok)[0]
    for i in slow:
        m = measure_one(data[starts[i] : starts[i] + lens[i]].tobytes())
        if m is not None:
            lon[i], lat[i], area[i] = m
            ok[i] = True
    return lon, lat, area, ok


def _measure_batch(geom: pa.Array) -> pa.Array:
    lon, lat, area, ok = measure_arrays(geom)
    mask = pa.array(~ok)
    return pa.StructArray.from_arrays(
        [pa.array(lon, mask=~ok), pa.array(lat, mask=~ok), pa.array(area, mask=~ok)],
        names=["lon", "lat", "area_deg2"],
        mask=mask,
    )


measure_wkb = F.arrow_udf(_measure_batch, MEASURE_TYPE)


def _reason_batch(geom: pa.Array) -> pa.Array:
    return pa.array([reason_of(b) for b in geom.to_pylist()], pa.string())


_reason_wkb = F.arrow_udf(_reason_batch, T.StringType())


def reject_reason(geometry: str) -> Column:
    """Reason code of a geometry that cannot be measured, null for one that can: ``missing`` (null or
    no bytes), ``cut_short``, ``unknown_type``, ``no_vertices``, ``not_finite``. Walks one row at a
    time, so it is for rows that are rejected already."""
    return _reason_wkb(F.col(geometry))


def _point_batch(lon: pa.Array, lat: pa.Array) -> pa.Array:
    """Little-endian WKB POINTs (21 bytes each) for whole columns."""
    x = lon.to_numpy(zero_copy_only=False).astype(np.float64)
    y = lat.to_numpy(zero_copy_only=False).astype(np.float64)
    n = len(x)
    rec = np.zeros(n, dtype=np.dtype([("bo", "u1"), ("t", "<u4"), ("x", "<f8"), ("y", "<f8")]))
    rec["bo"], rec["t"], rec["x"], rec["y"] = 1, WKB_POINT, x, y
    offsets = (np.arange(n + 1, dtype=np.int32) * rec.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(rec.tobytes())])


point_wkb = F.arrow_udf(_point_batch, T.BinaryType())


def with_measures(df: DataFrame, geometry: str = "geometry", prefix: str = "") -> DataFrame:
    """Add ``lon``, ``lat`` (centroid) and ``area_deg2`` (planar area).

    NULL for NULL, empty or unreadable geometry.
    """
    m = f"__m_{geometry}"
    return (
        df.withColumn(m, measure_wkb(F.col(geometry)))
        .withColumn(f"{prefix}lon", F.col(f"{m}.lon"))
        .withColumn(f"{prefix}lat", F.col(f"{m}.lat"))
        .withColumn(f"{prefix}area_deg2", F.col(f"{m}.area_deg2"))
        .drop(m)
    )


# ---------------------------------------------------------------------------
# scalar Column functions
# ---------------------------------------------------------------------------


def footprint_m2(area_deg2, lat):
    """Area in m2: area_deg2 * 111320^2 * cos(lat) (cos-latitude rule).

    Accepts Columns or :class:`dual.Sql` (same operations in both).
    """
    return area_deg2 * (DEG_TO_M * DEG_TO_M) * D.cos(lat * DEG2RAD)


def geometry_type_sql(w: str) -> str:
    """Geometry type name read from the WKB header (no parsing), SQL text.

    Byte 1 is the byte order; bytes 2..5 the type code, EWKB flag bits
    masked, ISO Z/M variants folded (code % 1000).
    """
    le = f"hex(concat(substring({w}, 5, 1), substring({w}, 4, 1), substring({w}, 3, 1), substring({w}, 2, 1)))"
    be = f"hex(substring({w}, 2, 4))"
    code = f"CAST(conv(CASE WHEN substring({w}, 1, 1) = X'01' THEN {le} ELSE {be} END, 16, 10) AS BIGINT)"
    base = f"(({code} & {0x0FFFFFFF}) % 1000)"
    names = " ".join(f"WHEN {k} THEN '{v}'" for k, v in GEOMETRY_TYPE_NAMES.items())
    return (
        f"CASE WHEN {w} IS NULL OR length({w}) < 5 THEN NULL "
        f"ELSE (CASE {base} {names} ELSE 'UNKNOWN' END) END"
    )


def geometry_type(wkb: str) -> Column:
    return F.expr(geometry_type_sql(wkb))
