"""Spatial thinning: assign every point the zoom at which it first appears.

For z in [minzoom, maxzoom): among points not yet assigned, the point with
the smallest ordering key in each snap cell (spacing 360/2^z degrees) gets
zoom z. Everything left gets maxzoom. Snap grids of successive zooms are
centred on multiples of their spacing, so they do not nest and the loop
cannot be replaced by one closed-form pass.

Plan::

    points (materialised once, numbered in key order)
    per tier of four zooms: points --left_anti--> picks of earlier tiers
        -> candidates: the first 4 * (zooms of the tier - 1) + 1 points left in
           each base cell, a limit that Spark applies per task before it shuffles
        -> regions of snap cells of the tier's first zoom, each with a border
           of two such cells -> one shuffle and sort by region -> all zooms of the tier,
           batch after batch; picks in the region proper are written

A snap cell of zoom z meets at most four of each earlier zoom, so of the points that a tier
finds there at most 4 * (z - first zoom of the tier) are taken before its turn, and its pick is
one of the first 4 * (z - first) + 1. All cell borders of zooms up to z lie on
multiples of the spacing of z + 1: a base cell of that spacing lies whole in
one snap cell of each zoom, and the first points of a snap cell are among the
first points of its base cells. So a tier's regions read a number of points bounded by
the area covered, however dense the points are.

Whether a point is picked at zoom z follows from the points of its snap cell, and
whether one of those is taken from the points of its cell a zoom before. Over a tier that
reaches less than twice the spacing of the tier's first zoom, so the border holds all
that the region's picks depend on.

Points of a region come in order of their numbers. A point is picked at the first zoom
at which none before it has taken its cell, so nothing but the taken cells is kept from one batch to
the next: of a region of 20 x 20 cells with its border, 85 times 400 of all four zooms.

Every tier writes its picks to the shared checkpoint folder, which cuts
lineage and lets a rerun resume after the last finished tier. How picks are
joined is left to the optimizer, by their size at run time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.constants import DEFAULT_MAXZOOM, DEFAULT_MINZOOM
from tessera.functions.tiles import snap_cell
from tessera.session import checkpoint_root
from tessera.sources.writers import checkpointed

Key = str | Sequence[str]

#: Zooms solved at a time.
TIER = 4
#: Side of a region and width of its border, in snap cells of the tier's first zoom. The side is a power of two, and
#: larger from a zoom on whose regions are many: fewer points then lie in borders.
SIDE_BITS, FINE_SIDE_BITS, FINE_FROM, BORDER = 3, 4, 9, 2
#: Index of points without a coordinate, and the bound on indices that make regions.
NOWHERE, FAR = -(1 << 41), 1 << 40


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fingerprint(points: DataFrame, columns: list[str]) -> str:
    """Names the content of a frame, whatever the order of its rows."""
    h = F.xxhash64(*columns)
    r = points.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1 << 31))).alias("s")).first()
    return f"{r['n']}-{(r['x'] or 0) & (2**64 - 1):016x}-{r['s'] or 0}"


def _candidates(pts: DataFrame, minzoom: int, maxzoom: int, lon: str, lat: str) -> DataFrame:
    """The first points of each base cell: no other can be picked in the zooms [minzoom, maxzoom)."""
    step = 360.0 / (1 << maxzoom)
    base = [F.floor(F.col(c) / step) for c in (lon, lat)]
    # all snap cells go into the group: a point that rounding puts just over a border is its own group. They
    # count as they differ from the base cell's, which is hardly ever, so that shuffled rows stay small
    over = []
    for z in range(minzoom, maxzoom):
        up = maxzoom - z
        for c, b in zip(snap_cell(lon, lat, z), base):
            over.append(c.bitwiseXOR(F.shiftright(b, up) + F.shiftright(b, up - 1).bitwiseAND(F.lit(1))))
    w = Window.partitionBy(*base, F.xxhash64(*over)).orderBy("__sk")
    most = 4 * (maxzoom - 1 - minzoom) + 1
    return pts.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def _finer(first: int, end: int) -> list[tuple[str, str]]:
    """Cell columns of a tier after its first zoom, each with the one a zoom before."""
    return [(f"{c}{z}", f"{c}{z - 1}") for z in range(first + 1, end) for c in "xy"]


def _region_picks(first: int, end: int):
    """Function that gives the picks of batches whose rows come region after region, in order of ``__sk``."""

    def by_region(batches):
        region, taken = None, {}  # cells taken in the one region that may go on in the next batch
        for left in batches:
            if left.empty:
                continue
            rx, ry = left["rx"].to_numpy(), left["ry"].to_numpy()
            number = np.cumsum(np.r_[0, (rx[1:] != rx[:-1]) | (ry[1:] != ry[:-1])])
            if region != (rx[0], ry[0]):
                taken = {}
            region = rx[-1], ry[-1]
            left = left.drop(columns=["rx", "ry"]).assign(region=number)
            for c, coarser in _finer(first, end):
                left[c] = left[c].to_numpy() ^ (left[coarser].to_numpy() << 1)
            out = []
            for z in range(first, end):
                cell = ["region", f"x{z}", f"y{z}"]
                old = taken[z].assign(region=0) if z in taken else left[cell].iloc[:0]
                later = pd.concat([old, left[cell]]).duplicated().to_numpy()[len(old) :]
                out.append(left.loc[~later & left["home"].to_numpy(), ["__sk"]].assign(zoomlevel=z))
                now = pd.concat([old, left.loc[~later, cell]])
                taken[z] = now[now["region"] == number[-1]]
                left = left[later]
            yield pd.concat(out)

    return by_region


def _tier_picks(pts: DataFrame, first: int, end: int, lon: str, lat: str) -> DataFrame:
    """Picks ``(__sk, zoomlevel)`` of the zooms [first, end) among ``pts``, none of which is taken yet."""
    bits = SIDE_BITS if first < FINE_FROM else FINE_SIDE_BITS
    cells = {}
    for z in range(first, end):
        x, y = snap_cell(lon, lat, z)
        cells |= {f"x{z}": F.coalesce(x, F.lit(NOWHERE)), f"y{z}": F.coalesce(y, F.lit(NOWHERE))}
    rows = pts.select("__sk", *(c.alias(n) for n, c in cells.items()))
    near = {"rx": f"least(greatest(x{first}, {-FAR}), {FAR})", "ry": f"least(greatest(y{first}, {-FAR}), {FAR})"}
    home = " AND ".join(f"shiftright({v}, {bits}) = {r}" for r, v in near.items())
    for r, v in near.items():
        rows = rows.withColumn(r, F.expr(f"explode(sequence(shiftright({v} - {BORDER}, {bits}), shiftright({v} + {BORDER}, {bits})))"))
    rows = rows.withColumn("home", F.expr(home))
    # a cell as it differs from twice the one a zoom before: small numbers, which shuffle well
    rows = rows.withColumns({c: F.col(c).bitwiseXOR(F.shiftleft(F.col(coarser), 1)) for c, coarser in _finer(first, end)})
    ordered = rows.repartition("rx", "ry").sortWithinPartitions("rx", "ry", "__sk")
    return ordered.mapInPandas(_region_picks(first, end), "__sk long, zoomlevel int")


def zoom_picks(
    points: DataFrame,
    minzoom: int = DEFAULT_MINZOOM,
    maxzoom: int = DEFAULT_MAXZOOM,
    key: Key = "id",
    lon: str = "lon",
    lat: str = "lat",
    workdir: str | None = None,
    one_input: bool = False,
    keep: Sequence[str] = (),
    check_key: bool = False,
) -> DataFrame:
    """Rows picked below maxzoom: ``(key, *keep, zoomlevel)``, read back from files.

    ``key`` (one column or several) must be unique; its order fixes which point
    of a cell wins, so results do not depend on scan order. In a given
    ``workdir`` each input, key and zoom range has a folder of its own, and a
    rerun over the same ones resumes there. ``one_input``: the folder is of these points alone, which
    spares reading them to name it. ``check_key`` raises where a key repeats or is null.
    """
    spark: SparkSession = points.sparkSession
    keys = key_columns(key)
    points = points.select(*keys, lon, lat, *keep)
    if workdir:
        of = "points" if one_input else fingerprint(points, points.columns)
        work = f"{workdir}/{'-'.join(keys)}-{minzoom}-{maxzoom}-{of}"
    else:
        work = f"{checkpoint_root(spark)}/thin-{uuid.uuid4().hex}"
    # Range-partition and sort by the key once, then number the rows:
    # monotonically_increasing_id() grows with the key, so min(__sk) per
    # cell is the smallest key, and every pass works on 8-byte LONGs
    # (hash aggregate, cheap shuffle) instead of the key.
    ordered = points.repartitionByRange(*keys)
    if check_key:
        # a window by key needs no more than the range and the sort that numbering takes anyway
        ordered = ordered.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
    else:
        ordered = ordered.sortWithinPartitions(*keys)
    pts = checkpointed(ordered.withColumn("__sk", F.monotonically_increasing_id()), f"{work}/points")
    if check_key and not pts.where(" OR ".join(["__nth > 1", *(f"`{k}` IS NULL" for k in keys)])).isEmpty():
        raise ValueError(f"the key repeats or is null: {', '.join(keys)}")
    if maxzoom <= minzoom:
        return pts.select(*keys, *keep, F.lit(None).cast("int").alias("zoomlevel")).limit(0)
    done: DataFrame | None = None
    for first in range(minzoom, maxzoom, TIER):
        end = min(first + TIER, maxzoom)
        left = pts.select("__sk", lon, lat)
        left = left if done is None else left.join(done.select("__sk"), "__sk", "left_anti")
        picks = checkpointed(_tier_picks(_candidates(left, first, end, lon, lat), first, end, lon, lat), f"{work}/picks-{first}-{end}")
        done = picks if done is None else done.unionByName(picks)
    return pts.select("__sk", *keys, *keep).join(done, "__sk").select(*keys, *keep, "zoomlevel")


def attach_zoom(df: DataFrame, picks: DataFrame, maxzoom: int = DEFAULT_MAXZOOM, key: Key = "id") -> DataFrame:
    """Source rows with their ``zoomlevel``: picked zoom, else maxzoom.

    A left join against the picks only (a small fraction of the rows)
    instead of an inner join against a full assignment table.
    """
    j = df.join(picks, key_columns(key), "left")
    return j.withColumn("zoomlevel", F.coalesce(F.col("zoomlevel"), F.lit(maxzoom)).cast("int"))


def assign_zoom(
    points: DataFrame,
    minzoom: int = DEFAULT_MINZOOM,
    maxzoom: int = DEFAULT_MAXZOOM,
    key: Key = "id",
    lon: str = "lon",
    lat: str = "lat",
    workdir: str | None = None,
) -> DataFrame:
    """``(key, zoomlevel)`` for every point (T1 as a whole)."""
    picks = zoom_picks(points, minzoom, maxzoom, key, lon, lat, workdir)
    return attach_zoom(points.select(*key_columns(key)), picks, maxzoom, key)


def zoom_counts(points: DataFrame, picks: DataFrame, maxzoom: int = DEFAULT_MAXZOOM) -> DataFrame:
    """Rows per zoom, ``(zoomlevel, n)``: the picks of each, and at maxzoom
    what is left of all points. Nothing is joined."""
    one = F.count(F.lit(1))
    per = picks.groupBy("zoomlevel").agg(one.alias("n"))
    rest = points.agg(one.alias("n")).unionByName(picks.agg((-one).alias("n"))).agg(F.sum("n").alias("n"))
    rest = rest.where("n > 0").select(F.lit(maxzoom).alias("zoomlevel"), "n")
    return per.unionByName(rest)


def zoom_counters(counts: DataFrame) -> DataFrame:
    """Per zoom of :func:`zoom_counts`: assigned rows and rows still
    unassigned after that zoom."""
    # one row per zoom (a dozen rows), so one ordered window is fine
    w = Window.orderBy("zoomlevel").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("zoomlevel", F.col("n").alias("assigned"), (total - F.sum("n").over(w)).alias("remaining"))


def scratch_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
