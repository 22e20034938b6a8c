"""Zoom pyramid of the source rows: thinning + quadkey + sorted layout.

Phases (each a Spark job, each restartable from its committed output):

A. measures: ``(key, lon, lat, quadkey)`` of every row, the quadkey as a number, materialised once;
   the only pass that sends geometry to Python;
B. thinning: picks per zoom (:mod:`tessera.operators.thinning`);
C. layout: source rows go to the range of their quadkey, whose borders the narrow
   table has fixed, and find their picks there; unpicked rows are maxzoom and stay, picked ones, which are
   few, go on to the range of their (zoomlevel, quadkey). So geometry is shuffled once. Rows are
   sorted and written as GeoParquet under ``zoomlevel=z/``;
D. metadata JSON from counts observed during the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.constants import (
    COMPRESSION,
    DEFAULT_MAXZOOM,
    DEFAULT_MINZOOM,
    LARGE_ZOOM_ROWS,
    PYRAMID_COLUMN_TEXTS,
    PYRAMID_COLUMNS,
    PYRAMID_ROW_GROUP,
)
from tessera.functions.measures import with_measures
from tessera.functions.tiles import quadkey_of_code, with_quadkey_code
from tessera.operators.thinning import Key, attach_zoom, fingerprint, key_columns, scratch_dir, zoom_picks
from tessera.sources.geoparquet import current_files, qualified, write_geoparquet
from tessera.sources.readers import scanned_files, with_row_identity
from tessera.sources.writers import checkpointed, write_metadata

#: Row identity of a file scan, unique whatever the ids are.
ROW_IDENTITY = ("file_path", "row_index")
QUADKEY_CODE = "__quadkey_code"
#: Rows of a range, which one task sorts and writes; smaller ones, of a row group or more, where cores would idle.
RANGE_ROWS = 2_000_000


def _work(src: DataFrame, keys: list[str], geometry: str, workdir: str | None) -> str:
    """A folder for this source: a given ``workdir`` gets one for each content.

    A plain file scan is known by its files (path, size, time, rows), without reading them; for any
    other frame keys and geometries are hashed.
    """
    if workdir is None:
        return scratch_dir(src.sparkSession, "pyramid")
    files = scanned_files(src)
    of = fingerprint(src, [*keys, geometry]) if files is None else f"files-{fingerprint(files, files.columns)}"
    return f"{workdir}/{'-'.join([*keys, geometry])}-{of}"


def _measured(src: DataFrame, maxzoom: int, keys: list[str], geometry: str, workdir: str) -> DataFrame:
    """``(key, lon, lat, quadkey_code)`` of every row of ``src``, stored."""
    m = with_measures(src.select(*keys, geometry), geometry)
    m = with_quadkey_code(m, "lon", "lat", maxzoom, QUADKEY_CODE).select(*keys, "lon", "lat", QUADKEY_CODE)
    return checkpointed(m, f"{workdir}/measured-{maxzoom}")


def zoomed_keys(src: DataFrame, minzoom: int, maxzoom: int, key: Key, geometry: str, workdir: str) -> DataFrame:
    """``(key, quadkey_code, zoomlevel)`` of every row of ``src``; the quadkey is a number as long as rows are shuffled."""
    keys = key_columns(key)
    m = _measured(src, maxzoom, keys, geometry, workdir)
    picks = zoom_picks(m, minzoom, maxzoom, keys, workdir=f"{workdir}/thinning", one_input=True)
    return attach_zoom(m.select(*keys, QUADKEY_CODE), picks, maxzoom, keys)


def _borders(rows: DataFrame, by: str, n: int) -> list[int]:
    """Values of ``by`` that part ``rows`` into ranges of a bounded number of rows; nulls come before all."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // RANGE_ROWS), min(cores, -(-n // PYRAMID_ROW_GROUP)))
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    return sorted(set(rows.agg(F.percentile_approx(F.expr(by), at, 100 * parts)).first()[0] or []))


def _range_sql(value: str, borders: list[int], first: int = 0) -> str:
    """Number of the range that ``value`` lies in, by halving."""
    if not borders:
        return str(first)
    mid = len(borders) // 2
    below, above = _range_sql(value, borders[:mid], first), _range_sql(value, borders[mid + 1 :], first + mid + 1)
    return f"CASE WHEN {value} >= {borders[mid]} THEN {above} ELSE {below} END"


def _laid_out(src: DataFrame, minzoom: int, maxzoom: int, keys: list[str], geometry: str, workdir: str) -> tuple[DataFrame, int]:
    """Rows of ``src`` with ``zoomlevel`` and QUADKEY_CODE, by ranges of both and sorted, and how many there are."""
    m = _measured(src, maxzoom, keys, geometry, workdir)
    picks = zoom_picks(m, minzoom, maxzoom, keys, workdir=f"{workdir}/thinning", one_input=True, keep=(QUADKEY_CODE,), check_key=True)
    picks = checkpointed(picks, f"{workdir}/picked-{minzoom}-{maxzoom}")
    rows, at = m.count(), f"(CAST(zoomlevel AS BIGINT) * {1 << 2 * maxzoom} + {QUADKEY_CODE})"  # footer metadata only
    # one range has a border above all quadkeys: a constant would be no key of the join, which then would deal rows out anew
    places, zooms = _borders(m, QUADKEY_CODE, rows) or [1 << 62], _borders(picks, at, picks.count())
    place = F.expr(_range_sql(QUADKEY_CODE, places)).alias("__range")
    # keys are not null, as has been checked; said here, the plans of both halves are alike up to the geometry's
    # shuffle, which then runs once
    whole = with_quadkey_code(with_measures(src.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)), geometry), "lon", "lat", maxzoom, QUADKEY_CODE)
    whole = whole.select(*src.columns, QUADKEY_CODE, place).repartitionById(len(places) + 1, "__range")
    found = picks.select(*keys, "zoomlevel", place).repartitionById(len(places) + 1, "__range")
    # a range's picks are fewer than its rows, and are bounded with them
    placed = whole.join(found.hint("shuffle_hash"), ["__range", *keys], "left").drop("__range")
    placed = placed.withColumn("zoomlevel", F.coalesce("zoomlevel", F.lit(maxzoom)))
    picked = placed.where(F.col("zoomlevel") < maxzoom).withColumn("__range", F.expr(_range_sql(at, zooms)))
    picked = picked.repartitionById(len(zooms) + 1, "__range").drop("__range")
    return placed.where(F.col("zoomlevel") >= maxzoom).unionByName(picked).sortWithinPartitions("zoomlevel", QUADKEY_CODE), rows


def pyramid_frame(
    src: DataFrame,
    minzoom: int = DEFAULT_MINZOOM,
    maxzoom: int = DEFAULT_MAXZOOM,
    key: Key | None = None,
    geometry: str = "geometry",
    workdir: str | None = None,
) -> DataFrame:
    """Source rows with ``zoomlevel`` and ``quadkey`` (not yet written).

    Without ``key`` rows are known by file and row number, for which ``src``
    must be a scan of files; a ``key`` must be unique. A given ``workdir`` lets a
    rerun over the same rows resume.
    """
    keys = key_columns(ROW_IDENTITY if key is None else key)
    scan, src = src, with_row_identity(src) if key is None else src
    workdir = _work(scan if workdir and scanned_files(scan) is not None else src, keys, geometry, workdir)
    out = src.join(zoomed_keys(src, minzoom, maxzoom, keys, geometry, workdir), keys)
    return out.select("zoomlevel", quadkey_of_code(QUADKEY_CODE, maxzoom).alias("quadkey"), *src.columns)


def build_pyramid(
    src: DataFrame,
    output: str,
    minzoom: int = DEFAULT_MINZOOM,
    maxzoom: int = DEFAULT_MAXZOOM,
    key: Key | None = None,
    geometry: str = "geometry",
    workdir: str | None = None,
    max_file_rows: int = LARGE_ZOOM_ROWS // 12,
) -> dict:
    """Write the pyramid and its metadata; returns the metadata dict.

    No file holds more than ``max_file_rows``: a range with more rows goes on in another
    file. Raises where a ``key`` repeats or is null, before anything is
    written, and if the rows written are not as many as the source's.
    """
    spark = src.sparkSession
    keys = key_columns(ROW_IDENTITY if key is None else key)
    scan, src = src, with_row_identity(src) if key is None else src
    workdir = _work(scan if workdir and scanned_files(scan) is not None else src, keys, geometry, workdir)
    columns = [c for c in PYRAMID_COLUMNS if c in src.columns and c != geometry]
    frame, rows = _laid_out(src.select(*dict.fromkeys([*keys, *columns, geometry])), minzoom, maxzoom, keys, geometry, workdir)
    frame = frame.withColumn("quadkey", quadkey_of_code(QUADKEY_CODE, maxzoom))
    written = write_geoparquet(
        frame.select("zoomlevel", "quadkey", *columns, geometry), output, partition_by="zoomlevel",
        row_group_size=PYRAMID_ROW_GROUP, geometry=geometry, max_rows_per_file=max_file_rows,
    )
    if written != rows:
        raise ValueError(f"{written} rows written of {rows}: the source has changed")
    meta = {
        "type": "pyramid_geoparquet",
        "algorithm": "spatial_thinning",
        "minzoom": minzoom,
        "maxzoom": maxzoom,
        "quadkey_zoom": maxzoom,
        "sort_order": ["zoomlevel", "quadkey"],
        "partitioning": {"column": "zoomlevel", "type": "hive"},
        "compression": COMPRESSION,
        "row_group_size": PYRAMID_ROW_GROUP,
        "crs": "EPSG:4326",
        "columns": {c: PYRAMID_COLUMN_TEXTS[c] for c in ("zoomlevel", "quadkey", *columns, "geometry")},
        "rows_written": written,
    }
    write_metadata(spark, f"{output}/_metadata.json", meta)
    return meta


def read_pyramid(spark, root: str, zoom: int | None = None) -> DataFrame:
    """Scan of the pyramid; geometry comes back as WKB.

    With ``zoom`` only that zoom's folder is read.
    """
    from tessera.sources.geoparquet import read_geoparquet

    if zoom is None:
        return read_geoparquet(spark, root)
    return read_geoparquet(spark, f"{root}/zoomlevel={zoom}").withColumn("zoomlevel", F.lit(zoom))


def read_pyramid_attributes(spark, root: str) -> DataFrame:
    """The pyramid without its geometry, by Spark's own Parquet reader: folders are
    pruned by zoom, row groups by quadkey.

    Only files of the manifest, or ``*.parquet`` where there is none: Spark would otherwise
    take ``_metadata.json`` for a Parquet summary file.
    """
    schema = "quadkey string, source string, id string, height float, var float, region string, zoomlevel int"
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    files = current_files(spark, root)
    return reader.option("basePath", qualified(spark, root)).parquet(*files) if files else reader.parquet(root)
