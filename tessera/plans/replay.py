"""Repaired rows taken back into the index.

The job keeps a table of the rows that it could not measure. :func:`replay` takes geometries for some of
them, joins the other columns from the source and writes files under the job's work folder, one folder for
each file version that they come from. The next run of the job sums these files up like new tiles
and withdraws them when the file they come from is withdrawn or replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.measures import with_measures
from tessera.operators.index import FILE_KEY, with_file_key
from tessera.operators.validate import split_valid
from tessera.plans.index_job import present_entries, read_ledger
from tessera.sources.rejects import in_files, origin, read_rejects
from tessera.sources.writers import _fs_path, materialize


def open_rejects(spark: SparkSession, workdir: str) -> DataFrame:
    """``(FILE_KEY, tile_id, row_index, reason)`` of the present files' rejected rows that no replay has repaired."""
    entries = present_entries(read_ledger(spark, f"{workdir}/ledger")).select(*FILE_KEY, "tile_id").distinct()
    rows = read_rejects(spark, f"{workdir}/rejects", entries).join(entries, list(FILE_KEY))
    fs, p = _fs_path(spark, f"{workdir}/replays")
    if not fs.exists(p):
        return rows
    done = spark.read.schema("origin_row long, run string, tile_id string, origin string").parquet(f"{workdir}/replays")
    done = done.select("origin", F.col("origin_row").alias("row_index"))
    return rows.withColumn("origin", origin()).join(done, ["origin", "row_index"], "left_anti").drop("origin")


def replay(spark: SparkSession, source: str, workdir: str, repaired: DataFrame) -> int:
    """Store ``repaired`` (file_path, row_index, geometry) for the job's next run; returns the rows taken.

    Taken are rows that are open in :func:`open_rejects` and whose new geometry can be measured; others stay
    as they are. Several geometries for one row raise. Rows count once however often they are replayed.
    """
    place, run = ["file_path", "row_index"], uuid.uuid4().hex

    def kept(rows: DataFrame, name: str) -> DataFrame:
        """Rows that are used several times, stored, so that what gives them runs once."""
        materialize(rows, f"{workdir}/stages/replay-{run}/{name}")
        return spark.read.parquet(f"{workdir}/stages/replay-{run}/{name}")

    fixed = kept(repaired.select(*place, F.col("geometry").alias("__geometry")), "repaired")
    if not fixed.groupBy(*place).count().where("count > 1").isEmpty():
        raise ValueError("several geometries for one row")
    wanted = kept(open_rejects(spark, workdir).drop("reason").join(fixed, place), "wanted")
    scan = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(source)
    columns = [c for c in scan.columns if c not in ("geometry", *FILE_KEY, "tile_id", "origin", "origin_row")]
    rows = with_file_key(scan.select(*columns, "_metadata")).withColumn("row_index", F.col("_metadata.row_index")).drop("_metadata")
    rows = in_files(rows, wanted).join(wanted, [*FILE_KEY, "row_index"]).withColumnRenamed("__geometry", "geometry")
    rows, _ = split_valid(with_measures(rows))
    rows = rows.select(*columns, "geometry", "tile_id", F.col("row_index").alias("origin_row"), origin().alias("origin"))
    path = f"{workdir}/replays/run={run}"
    # a folder's rows go together: as many files as there are folders, not as many times the tasks
    rows.hint("rebalance", "tile_id", "origin").write.partitionBy("tile_id", "origin").option("compression", "zstd").parquet(path)
    return spark.read.schema("origin_row long").parquet(path).count()
