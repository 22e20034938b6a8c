"""Sources: tile listing, footprint scans, row identity, index/pyramid reads.

Scans are plain ``spark.read.parquet`` so Catalyst prunes columns and
pushes filters into the Parquet reader; nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_ID_PATTERN = r"([^/]+)\.parquet$"
HIVE_TILE_PATTERN = r"tile_id=([^/]+)/"


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of a source that is one split.

    A Parquet file with a single row group cannot be split, so a small
    source can land in one task; CPU-heavy per-row work (cells, WKB)
    then runs on one core. What is shuffled is never more than one split;
    sources of several are returned untouched.
    """
    spark = df.sparkSession
    if df.rdd.getNumPartitions() == 1:
        return df.repartition(min_partitions or spark.sparkContext.defaultParallelism)
    return df


def tile_id(path: Column | str = "_metadata.file_path") -> Column:
    """Tile id of a row: ``tile_id=X`` folder if present, else the file stem."""
    p = F.col(path) if isinstance(path, str) else path
    hive = F.regexp_extract(p, HIVE_TILE_PATTERN, 1)
    stem = F.regexp_extract(p, TILE_ID_PATTERN, 1)
    return F.when(hive != "", hive).otherwise(stem)


def list_tiles(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Source tiles under ``path``: ``path, length, mtime, tile_id``, sorted.

    File metadata only: ``binaryFile`` lists files in a distributed way and
    ``content`` is never selected, so no byte of data is read.
    """
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("mtime"))
    )
    return df.withColumn("tile_id", tile_id(F.col("path"))).orderBy("path")


def dry_run(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """Count of tiles plus the first ``n`` paths (the preview of a run)."""
    t = list_tiles(spark, path)
    n_tiles = t.count()  # file metadata only
    return t.limit(n).withColumn("n_tiles", F.lit(n_tiles))


def read_footprints(spark: SparkSession, path: str, columns=None, hive: bool = False) -> DataFrame:
    """Scan source tiles (file or folder); only ``columns`` are read.

    ``hive=False`` ignores ``key=value`` folders (recursive lookup) like a
    flat multi-file glob; ``tile_id`` is derived from each row's file.
    """
    r = spark.read
    if not hive:
        r = r.option("recursiveFileLookup", "true")
    df = r.parquet(path)
    df = df.withColumn("tile_id", tile_id())
    if columns:
        df = df.select(*columns, "tile_id")
    return df


def with_row_identity(df: DataFrame) -> DataFrame:
    """Add ``file_path`` and ``row_index`` (position in its Parquet file).

    A deterministic identity without any global window or sort; the pair is
    unique whatever the ids in the rows are, and orders like a row number over
    the files in path order. Use directly on a file scan.
    """
    return df.withColumn("file_path", F.col("_metadata.file_path")).withColumn(
        "row_index", F.col("_metadata.row_index")
    )


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a file scan with no more than some of its columns picked."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() == "Project":
        picked = plan.projectList()
        if any(picked.apply(i).getClass().getSimpleName() != "AttributeReference" for i in range(picked.size())):
            return False
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"


def scanned_files(df: DataFrame) -> DataFrame | None:
    """``(file_path, file_size, file_time, rows)`` of the files that a plain file scan
    reads, or None where ``df`` is anything else.

    No column is read: row counts come from the footers. Files without rows are left out.
    """
    if not _plain_scan(df):
        return None
    meta = {"file_path": "file_path", "file_size": "file_size", "file_time": "file_modification_time"}
    files = df.select(*(F.col(f"_metadata.{m}").alias(n) for n, m in meta.items()))
    return files.groupBy(*meta).agg(F.count(F.lit(1)).alias("rows"))


def read_index(spark: SparkSession, root: str, layout: str = "hive") -> DataFrame:
    """Index written by :func:`write_index` (``h3_res=N/``) or a foreign
    ``**/data.parquet`` layout whose resolution is in the folder name."""
    if layout == "hive":
        # *.parquet only: ``_metadata.json`` would pass for a summary file
        return spark.read.option("pathGlobFilter", "*.parquet").parquet(root)
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "data.parquet")
        .parquet(root)
    )
    res = F.regexp_extract(F.col("_metadata.file_path"), r"h3_res=(\d+)", 1).cast("int")
    return df.withColumn("h3_res", res)


def read_population(spark: SparkSession, root: str, scenario: str = "SSP2", res: int = 5) -> DataFrame:
    """Side table under ``scenario=/h3_res=`` folders; both are partition
    filters, so only the matching folder is listed and read."""
    return (
        spark.read.parquet(root)
        .where((F.col("scenario") == scenario) & (F.col("h3_res") == res))
        .select("h3_index", "pop_2025")
    )


def tile_status(tiles: DataFrame, df: DataFrame) -> DataFrame:
    """Per listed tile: row count and ``done`` / ``skipped_empty``."""
    counts = df.groupBy("tile_id").agg(F.count(F.lit(1)).alias("rows"))
    # a tile may span several files (e.g. a Spark-written tile_id= folder)
    j = tiles.select("tile_id").distinct().join(counts, "tile_id", "left")
    return j.select(
        "tile_id",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("rows").isNull(), F.lit("skipped_empty")).otherwise(F.lit("done")).alias("status"),
    )
