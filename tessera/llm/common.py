"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_root

#: ASCII white space, as a character class body: space, tab, LF, VT, FF, CR.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, so work above it is neither repeated nor lost with an
    executor; the folder is the one named in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that start with ``names`` and that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``text``
    (one row at least), which bounds what a task holds at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch, null read as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``starts[i] .. starts[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def release() -> None:
    """Give memory that is free again back to the system: a worker lives on
    between tasks and counts towards its executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: bool = False):
    """``run``, with :func:`release` at the end of each task; unless ``keep``,
    what an earlier operator has kept in the worker goes first."""

    def to_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            _kept().pop("value", None)
            _kept().pop("key", None)
        try:
            yield from run(batches)
        finally:
            release()

    return to_end


def _kept() -> dict:
    return sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__


def worker_value(key: str, make: Callable[[], object]):
    """A value that a Python worker keeps from task to task, one at a time.

    Functions travel to the workers by value, so a module's own globals start
    afresh in every task; a module of the worker's process does not.
    """
    own = _kept()
    if own.get("key") != key:
        own["value"] = None
        own["value"], own["key"] = make(), key
    return own["value"]


def fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4 (0 for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)), F.lit(0))
