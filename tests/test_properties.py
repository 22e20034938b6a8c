"""Property tests (hypothesis) for the two core invariants."""

import struct

import numpy as np
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions.measures import measure_arrays, measure_one

coord = st.floats(min_value=-179.0, max_value=179.0, allow_nan=False, allow_infinity=False)
size = st.floats(min_value=1e-6, max_value=0.5, allow_nan=False, allow_infinity=False)


def ring(cx, cy, r, n, cw=False):
    ang = np.linspace(0, 2 * np.pi, n, endpoint=False)
    if cw:
        ang = ang[::-1]
    pts = [(cx + r * np.cos(a), cy + r * np.sin(a) * 0.7) for a in ang]
    return pts + [pts[0]]


def polygon_wkb(rings, le=True):
    e = "<" if le else ">"
    out = bytes([1 if le else 0]) + struct.pack(e + "II", 3, len(rings))
    for r in rings:
        out += struct.pack(e + "I", len(r)) + b"".join(struct.pack(e + "dd", *p) for p in r)
    return out


@st.composite
def polygons(draw):
    cx, cy, r = draw(coord), draw(st.floats(-80, 80)), draw(size)
    n = draw(st.integers(3, 40))
    rings = [ring(cx, cy, r, n, cw=draw(st.booleans()))]
    for _ in range(draw(st.integers(0, 3))):
        rings.append(ring(cx, cy, r * draw(st.floats(0.05, 0.3)), draw(st.integers(3, 12)), cw=draw(st.booleans())))
    return polygon_wkb(rings, le=draw(st.booleans()))


@settings(max_examples=60, deadline=None)
@given(st.lists(polygons(), min_size=1, max_size=25))
def test_vectorised_measure_equals_per_geometry_walk(geoms):
    lon, lat, area, ok = measure_arrays(pa.array(geoms, type=pa.binary()))
    for i, g in enumerate(geoms):
        m = measure_one(g)
        assert ok[i] == (m is not None)
        if m is not None:
            assert np.isclose(lon[i], m[0], rtol=0, atol=1e-9)
            assert np.isclose(lat[i], m[1], rtol=0, atol=1e-9)
            assert np.isclose(area[i], m[2], rtol=1e-9, atol=1e-18)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(2, 7), st.integers(0, 1000))
def test_any_tile_split_merges_to_direct(spark, k, salt):
    from pyspark.sql import functions as F

    from tessera.operators import index as ix
    from tessera.sources import fixtures as fx

    fp = fx.footprints(spark, "/root/testdata/sf0.001").withColumn(
        "split", (F.abs(F.xxhash64("id", F.lit(salt))) % k).cast("string")
    )
    direct = sorted(map(tuple, ix.build_index(fp, [3, 6]).collect()))
    merged = sorted(map(tuple, ix.merge_partials(ix.partials(fp, [3, 6], tile_col="split")).collect()))
    assert len(direct) == len(merged)
    for x, y in zip(direct, merged):
        assert x[:3] == y[:3]
        for u, v in zip(x[3:], y[3:]):
            assert (u is None and v is None) or abs(u - v) <= 1e-5 * max(1.0, abs(u))
