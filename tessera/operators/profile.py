"""Source profiling: per-file counts, height summary, distributions, samples.

All are grouped aggregates with map-side partial aggregation; the one
window (share of total) runs over an already-grouped, tiny frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.index import valid_height_sql


def tile_row_counts(df: DataFrame, by: str = "tile_id", with_total: bool = False) -> DataFrame:
    """Rows per source file (or tile); ``with_total`` adds a NULL-key total row."""
    if with_total:
        return df.rollup(by).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.col(by).asc_nulls_last())
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).orderBy(by)


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per physical Parquet file of a scan (from ``_metadata``)."""
    return tile_row_counts(df.select(F.col("_metadata.file_path").alias("file_path")), "file_path")


def height_summary(df: DataFrame, height: str = "height") -> DataFrame:
    """count, with/without height, avg, exact median, max, min (valid heights).

    The sentinel, NULL and NaN are no height. Rows are counted per height first, so
    what meets in the last aggregate is one row for each distinct height, and the
    median is Spark's exact one over (height, count).
    """
    h = F.expr(valid_height_sql(height))
    per = df.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("h").isNotNull(), F.col("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_buildings"),
        F.coalesce(F.sum(n), F.lit(0)).alias("with_height"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).alias("no_height"),
        F.try_divide(F.sum(F.col("h") * F.col("n")), F.sum(n)).cast("float").alias("avg_height"),
        F.percentile("h", F.lit(0.5), F.col("n")).cast("float").alias("median_height"),
        F.max("h").cast("float").alias("max_height"),
        F.min("h").cast("float").alias("min_height"),
    )


def source_distribution(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows per source with their share of all rows (percent, FLOAT).

    The share uses ``sum(n) OVER ()`` on the grouped frame, which has one
    row per source (a handful), never on the rows themselves.
    """
    from pyspark.sql import Window

    per = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return per.select(by, "n", (F.col("n") * 100.0 / total).cast("float").alias("pct")).orderBy(
        F.col("n").desc(), by
    )


def top_regions(df: DataFrame, n: int = 20, by: str = "region") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), by).limit(n)


def sample_rows(df: DataFrame, n: int = 5, seed: int = 42, key: str = "id", drop=("geometry",)) -> DataFrame:
    """Exactly ``n`` pseudo-random rows, repeatable for a seed, no geometry.

    Rows are ranked by ``md5(key || ':' || seed)`` (the same digest in any
    SQL engine) and the first ``n`` kept: a top-n (a bounded heap per
    task), not a global sort.
    """
    cols = [c for c in df.columns if c not in set(drop)]
    rank = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.select(*cols).orderBy(rank, key).limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """(column_name, column_type) from the schema alone (footer, no scan)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    schema = T.StructType(
        [T.StructField("column_name", T.StringType()), T.StructField("column_type", T.StringType())]
    )
    return spark.createDataFrame(rows, schema)
