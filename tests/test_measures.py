import struct

import numpy as np
import pyarrow as pa

from tessera.functions.measures import geometry_type, measure_arrays, measure_one
from tessera.sources.fixtures import rect_wkb_arrays


def poly(rings, le=True, srid=None):
    e = "<" if le else ">"
    code = 3 | (0x20000000 if srid else 0)
    out = bytes([1 if le else 0]) + struct.pack(e + "I", code)
    if srid:
        out += struct.pack(e + "I", srid)
    out += struct.pack(e + "I", len(rings))
    for r in rings:
        out += struct.pack(e + "I", len(r)) + b"".join(struct.pack(e + "dd", *p) for p in r)
    return out


SQ = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
HOLE = [(0.5, 0.5), (0.5, 1.5), (1.5, 1.5), (1.5, 0.5), (0.5, 0.5)]


def test_fixture_rectangles_exact():
    rng = np.random.default_rng(7)
    n = 5000
    lon = rng.integers(-700000, 700000, n) / 4096.0
    lat = rng.integers(-300000, 300000, n) / 4096.0
    hw = rng.integers(8, 65, n) / 1048576.0
    hh = rng.integers(1, 58, n) / 1048576.0
    hole = rng.random(n) < 0.33
    a, b, c, ok = measure_arrays(rect_wkb_arrays(lon, lat, hw, hh, hole))
    assert ok.all()
    assert np.array_equal(a, lon) and np.array_equal(b, lat)
    assert np.array_equal(c, 4 * hw * hh * np.where(hole, 0.75, 1.0))


def test_edge_geometries():
    mp = bytes([1]) + struct.pack("<II", 6, 2) + poly([SQ]) + poly([[(10, 10), (11, 10), (11, 11), (10, 11), (10, 10)]])
    point = bytes([1]) + struct.pack("<Idd", 1, 3.5, 4.5)
    cases = [
        poly([SQ]),  # plain
        poly([list(reversed(SQ))]),  # clockwise shell
        poly([SQ], le=False),  # big-endian
        poly([SQ, HOLE]),  # hole
        mp,  # multipolygon
        point,  # point: zero area
        poly([]),  # empty
        None,  # NULL
        poly([SQ])[:-7],  # truncated
        poly([SQ], srid=4326),  # EWKB with SRID
    ]
    lon, lat, area, ok = measure_arrays(pa.array(cases, type=pa.binary()))
    assert list(ok) == [True, True, True, True, True, True, False, False, False, True]
    assert (lon[0], lat[0], area[0]) == (1.0, 1.0, 4.0)
    assert (lon[1], lat[1], area[1]) == (1.0, 1.0, 4.0)
    assert (lon[2], lat[2], area[2]) == (1.0, 1.0, 4.0)
    assert (lon[3], lat[3], area[3]) == (1.0, 1.0, 3.0)
    assert area[4] == 5.0 and abs(lon[4] - (4 * 1 + 1 * 10.5) / 5) < 1e-12
    assert (lon[5], lat[5], area[5]) == (3.5, 4.5, 0.0)
    assert (lon[9], lat[9], area[9]) == (1.0, 1.0, 4.0)
    for i, c in enumerate(cases):
        if ok[i]:
            assert measure_one(c) is not None


def test_geometry_type_names(spark):
    mp = bytes([1]) + struct.pack("<II", 6, 0)
    df = spark.createDataFrame([(poly([SQ]),), (poly([SQ], le=False),), (mp,), (None,), (b"\x01",)], "g binary")
    got = [r[0] for r in df.select(geometry_type("g")).collect()]
    assert got == ["POLYGON", "POLYGON", "MULTIPOLYGON", None, None]


def test_valid_height_sentinels(spark):
    from tessera.operators.index import valid_height_sql

    df = spark.createDataFrame([(5.0,), (-999.0,), (None,), (float("nan"),)], "height float")
    got = [r[0] for r in df.selectExpr(valid_height_sql("height")).collect()]
    assert got == [5.0, None, None, None]


def multi(polys):
    return bytes([1]) + struct.pack("<II", 6, len(polys)) + b"".join(polys)


def test_multipolygons_in_a_block_equal_the_walk():
    from tessera.functions import measures

    rng = np.random.default_rng(11)

    def ring(n):
        p = rng.uniform(-5, 5, 2) + rng.uniform(0.1, 2, 2) * rng.normal(size=(n, 2))
        return [tuple(x) for x in np.concatenate([p, p[:1]])]

    cases = []
    for _ in range(300):
        polys = [poly([ring(rng.integers(3, 9)) for _ in range(rng.integers(0, 4))]) for _ in range(rng.integers(0, 5))]
        cases += [multi(polys), polys[0] if polys else None, multi(polys)[:-3], multi(polys) + b"x", multi([*polys, poly([SQ], le=False)])]
    arr = pa.array(cases, type=pa.binary())
    lon, lat, area, ok = measure_arrays(arr)
    # what the block path itself took
    data = np.frombuffer(b"".join(c or b"" for c in cases), np.uint8)
    assert len(data) > 0 and ok.sum() > 300
    for i, c in enumerate(cases):
        want = measures.measure_one(c)
        assert (want is not None) == ok[i]
        if want is not None:
            assert np.allclose((lon[i], lat[i], area[i]), want, rtol=1e-9, atol=1e-9)


def test_lines_and_flat_shapes_weigh_by_length():
    line = bytes([1]) + struct.pack("<II", 2, 3) + struct.pack("<6d", 0, 0, 4, 0, 4, 2)
    flat = poly([[(0, 0), (6, 0), (2, 0), (0, 0)]])
    lon, lat, area, ok = measure_arrays(pa.array([line, flat], type=pa.binary()))
    # segments of length 4 and 2; 6, 4 and 2
    assert np.allclose((lon[0], lat[0], area[0]), ((4 * 2 + 2 * 4) / 6, (2 * 1) / 6, 0))
    assert np.allclose((lon[1], lat[1], area[1]), ((6 * 3 + 4 * 4 + 2 * 1) / 12, 0, 0)) and ok.all()


def test_ids_of_another_grid_raise(spark):
    import pytest

    from tessera.operators.queries import own_cells

    rows = spark.createDataFrame([(0x85283473FFFFFFF,)], "h3_index long")
    with pytest.raises(Exception, match="85283473fffffff"):
        own_cells(rows).collect()
