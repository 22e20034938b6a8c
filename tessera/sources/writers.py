"""Sinks: partials, index, pyramid, metadata, stage materialisation.

All writes go through Spark's commit protocol (task attempts write to
temporary names; the job commit publishes them and drops ``_SUCCESS``), so
a lost executor only re-runs its tasks and a half-written output is never
mistaken for a finished one.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import COMPRESSION, INDEX_COLUMNS, INDEX_ROW_GROUP, LARGE_ZOOM_ROWS, PYRAMID_ROW_GROUP
from tessera.functions.zones import cell_key


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def has_success(spark: SparkSession, path: str) -> bool:
    """True when a previous job committed ``path`` (``_SUCCESS`` present).

    Stronger than "the folder exists": a job that died mid-write leaves no
    marker, so the stage is redone.
    """
    fs, p = _fs_path(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(p))


def materialize(df: DataFrame, path: str, mode: str = "overwrite", count: bool = False) -> int | None:
    """Write a stage to the shared folder (cuts lineage; restartable).

    ``count=True`` returns the rows written, observed during the write
    itself (no second job over the data).
    """
    obs = None
    if count:
        from pyspark.sql import Observation

        obs = Observation()
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    df.write.mode(mode).option("compression", COMPRESSION).parquet(path)
    return int(obs.get["rows"]) if obs is not None else None


def checkpointed(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` at ``path`` unless already committed; read it back."""
    spark = df.sparkSession
    if not has_success(spark, path):
        materialize(df, path)
    return spark.read.parquet(path)


def write_partials(part: DataFrame, path: str, run: str) -> None:
    """Persist the partial rows of one run under ``run=/h3_res=`` folders.

    A rerun of the same run replaces its own folder; other runs stay. Range
    partitioning splits a huge file's cells over several tasks.
    """
    (
        part.repartitionByRange("h3_res", "h3_index")
        .write.mode("overwrite")
        .option("compression", COMPRESSION)
        .partitionBy("h3_res")
        .parquet(f"{path}/run={run}")
    )


def write_index(idx: DataFrame, path: str, files_per_res: int | None = None) -> None:
    """Index rows under ``h3_res=N/``, globally sorted by cell, ZSTD.

    Only the resolutions in ``idx`` are replaced; folders of others stay.

    Range partitioning on (h3_res, h3_index) gives sorted, similarly sized
    files; with the sort inside each file, Parquet min/max statistics on
    ``h3_index`` let readers skip row groups (bbox, cell lookups).
    """
    cols = ["h3_res", *INDEX_COLUMNS]
    df = idx.select(*cols)
    df = df.repartitionByRange(files_per_res, "h3_res", "h3_index") if files_per_res else df.repartitionByRange(
        "h3_res", "h3_index"
    )
    (
        df.sortWithinPartitions("h3_res", "h3_index")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .option("parquet.block.row.count.limit", INDEX_ROW_GROUP)
        .partitionBy("h3_res")
        .parquet(path)
    )


def write_index_by_key(idx: DataFrame, path: str, row_group: int = INDEX_ROW_GROUP // 8) -> None:
    """Index rows under ``h3_res=N/`` with their ``cell_key``, sorted by it.

    Near cells lie near each other on both axes, so the key ranges of a box
    (:func:`tessera.operators.queries.box`) leave out row groups east and west of it too;
    sorted by id, all cells of the box's latitudes would be read.
    """
    df = idx.select("h3_res", *INDEX_COLUMNS, cell_key("h3_index").alias("cell_key"))
    df = df.repartitionByRange("h3_res", "cell_key").sortWithinPartitions("h3_res", "cell_key", "h3_index")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    writer.option("parquet.block.row.count.limit", row_group).partitionBy("h3_res").parquet(path)


def write_pyramid(df: DataFrame, path: str) -> int:
    """Pyramid rows under ``zoomlevel=z/``, sorted by quadkey, ZSTD; returns
    the rows written, observed during the write.

    One pass: range partitioning on (zoomlevel, quadkey) splits big zooms
    into many quadkey ranges by size (what fixed 16-way prefix splits do by
    hand), each file sorted by quadkey with 131,072-row groups.
    """
    from pyspark.sql import Observation

    # observe after the exchange: the range-bounds sampling pass would
    # otherwise be counted as well
    obs = Observation()
    out = df.repartitionByRange("zoomlevel", "quadkey").observe(obs, F.count(F.lit(1)).alias("rows"))
    (
        out.sortWithinPartitions("zoomlevel", "quadkey")
        .write.mode("overwrite")
        .option("compression", COMPRESSION)
        .option("parquet.block.row.count.limit", PYRAMID_ROW_GROUP)
        # a zoom above the large-zoom threshold is spread over >= 16 files
        .option("maxRecordsPerFile", LARGE_ZOOM_ROWS // 16)
        .partitionBy("zoomlevel")
        .parquet(path)
    )
    return int(obs.get["rows"])


def write_metadata(spark: SparkSession, path: str, meta: dict) -> None:
    """One small JSON document (counts computed by Spark jobs beforehand)."""
    meta = dict(meta)
    meta.setdefault("processing_date", date.today().isoformat())
    text = json.dumps(meta, indent=2, sort_keys=True)
    fs, p = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_metadata(spark: SparkSession, path: str) -> dict:
    """Read the small JSON document back (file readers skip ``_``-names)."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(raw).decode("utf-8"))
