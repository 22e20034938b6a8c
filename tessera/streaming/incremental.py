"""Incremental partials from a folder that receives new tile files.

A file-source stream picks up new files; each micro-batch is measured once
and aggregated to partial sums per (file version, resolution, cell), rejected rows
included as rows without a cell, and written under
``partials/query=<stream id>/batch=<id>/``. Partials are additive, so there is no
state store and no watermark: the index is the merge of all batch folders,
rebuilt on demand (:func:`merge_stream_partials`).

Re-running a batch after a failure overwrites its own folder. A stream with a new
checkpoint has a new id, so it never writes into an older one's folders; what it
reads again is merged once, since a file always lies in one batch as a whole and its
version names its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import DEFAULT_RESOLUTIONS
from tessera.operators.index import FILE_KEY, FILE_PARTIALS_SCHEMA, file_partials, merge_partials, with_file_key
from tessera.sources.rejects import rejected_rows
from tessera.sources.writers import materialize, read_metadata


def start_partials_stream(
    spark: SparkSession,
    source: str,
    schema,
    partials_path: str,
    checkpoint: str,
    resolutions=DEFAULT_RESOLUTIONS,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    rejects_path: str | None = None,
):
    """Start the stream; returns the StreamingQuery.

    With ``rejects_path`` the rows that cannot be measured are written there with their reasons, again a
    folder per stream and batch, which takes a second pass over the batch's geometry.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = with_file_key(reader.parquet(source).select("geometry", "height", "_metadata"))
    stream = stream.withColumn("row_index", F.col("_metadata.row_index")).drop("_metadata")
    res = list(resolutions)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the id that Spark writes when a checkpoint is made
        query = read_metadata(spark, f"{checkpoint}/metadata")["id"]
        folder = f"query={query}/batch={batch_id}"
        if rejects_path:
            # first, so that a batch whose partials are there has its rejects too
            materialize(rejected_rows(batch), f"{rejects_path}/{folder}")
        materialize(file_partials(batch, res), f"{partials_path}/{folder}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_stream_partials(spark: SparkSession, partials_path: str) -> DataFrame:
    """Partial rows of every committed batch, each file version once.

    A file version lies in one batch of a stream; of several streams that read it, the
    first named one counts. Only the versions' names are compared, not the rows.
    """
    part = spark.read.schema(f"{FILE_PARTIALS_SCHEMA}, query string, batch long").parquet(partials_path)
    chosen = part.groupBy(*FILE_KEY).agg(F.min(F.struct("query", "batch")).alias("v")).select(*FILE_KEY, "v.query", "v.batch")
    return part.join(chosen, [*FILE_KEY, "query", "batch"], "left_semi").drop("query", "batch")


def merge_stream_partials(spark: SparkSession, partials_path: str) -> DataFrame:
    """Index rows from every committed batch so far."""
    return merge_partials(read_stream_partials(spark, partials_path).where("h3_index IS NOT NULL"))


def stream_rejects(spark: SparkSession, partials_path: str) -> DataFrame:
    """Rows set aside per file because their geometry could not be measured."""
    bad = read_stream_partials(spark, partials_path).where("h3_index IS NULL")
    return bad.groupBy("file_path").agg(F.max("building_count").alias("rejected"))


def read_stream_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """``(FILE_KEY, row_index, reason)`` of every batch, each row once whatever streams have read it."""
    columns = [*FILE_KEY, "row_index", "reason"]
    rows = spark.read.schema("file_path string, file_size long, file_time timestamp, row_index long, reason string, query string, batch long").parquet(rejects_path)
    return rows.select(columns).distinct()
