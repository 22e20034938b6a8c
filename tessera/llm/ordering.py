"""Places of rows in a total order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

#: ``monotonically_increasing_id`` keeps the partition above this bit.
PARTITION_BIT = 33


def numbered(df: DataFrame, *order, name: str, tag: str) -> DataFrame:
    """``df``, stored, with a long column ``name`` that ascends along ``order``.

    Rows are dealt to key ranges and sorted there, so numbers ascend from range
    to range and have gaps between them. Rows that tie in ``order`` follow
    each other in any order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn(name, F.monotonically_increasing_id()), tag)


def ranked(df: DataFrame, group: str, number: str) -> DataFrame:
    """A table of :func:`numbered`, sorted by ``group`` first, with ``pos``, each row's
    place in its group from 0, and ``n``, the group's rows. ``group`` has no nulls.

    Only counts per group and partition are summed up along the groups: a window
    holds as many rows as a group has partitions, whatever its size.
    """
    part = F.shiftright(number, PARTITION_BIT)
    counts = df.groupBy(group, part.alias("part")).agg(F.count("*").alias("rows"), F.min(number).alias("first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(group, "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    placed = df.withColumn("part", part).join(starts, [group, "part"])
    return placed.withColumn("pos", F.col(number) + F.col("shift")).drop("part", "shift", number)
