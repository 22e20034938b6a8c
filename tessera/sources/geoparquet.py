"""GeoParquet sink (native GEOMETRY logical type + ``geo`` footer) and check.

Spark's own Parquet writer cannot emit the GEOMETRY logical type, so this is
a Python Data Source with an Arrow writer. Each task writes its rows with
PyArrow to their folder, under names of its attempt. The job commit puts a manifest of
the committed files in place, which the readers here follow, and then deletes
all other files; nothing is renamed or moved as a folder. The geometry column is tagged
with the ``geoarrow.wkb`` extension type, which PyArrow maps to Parquet's
GEOMETRY type, and the GeoParquet ``geo`` key with the CRS is written into the
file footer.

Usage::

    register(spark)
    (df.repartitionByRange("zoomlevel", "quadkey").sortWithinPartitions("zoomlevel", "quadkey")
       .write.format("geoparquet").mode("overwrite")
       .option("partition_by", "zoomlevel").option("row_group_size", 131072)
       .save(path))
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from tessera.constants import CRS_PROJJSON

GEO_VERSION = "1.1.0"


class WkbType(pa.ExtensionType):
    """Arrow ``geoarrow.wkb`` extension over binary storage."""

    def __init__(self, crs: dict | str | None = None):
        self.crs = crs
        super().__init__(pa.binary(), "geoarrow.wkb")

    def __arrow_ext_serialize__(self) -> bytes:
        return json.dumps({"crs": self.crs} if self.crs else {}).encode()

    @classmethod
    def __arrow_ext_deserialize__(cls, storage_type, serialized):
        meta = json.loads(serialized or b"{}")
        return cls(meta.get("crs"))


def _register_wkb_type() -> None:
    try:
        pa.register_extension_type(WkbType())
    except pa.ArrowKeyError:
        pass  # already registered in this process


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark's own readers would take it; a view of other file systems, which
    only Hadoop knows, gives the path behind it. A file system of one machine is refused on a cluster, but for the folders that the
    cluster itself names as shared: the checkpoint folder and the warehouse."""

    def full(path: str) -> str:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        hpath, below = fs.makeQualified(hpath), ""
        if hpath.toString().startswith("viewfs:"):
            while hpath.getParent() is not None and not fs.exists(hpath):
                hpath, below = hpath.getParent(), f"/{hpath.getName()}{below}"
            hpath = fs.resolvePath(hpath)
        return f"{hpath.toString()}{below}"

    out = full(path)
    if out.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        named = (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(), spark.conf.get("spark.sql.warehouse.dir", None))
        # one spelling: file:/a, file:///a
        shared = [_fs(full(p))[1].rstrip("/") for p in named if p and full(p).startswith("file:")]
        if not any(f"{_fs(out)[1]}/".startswith(f"{root}/") for root in shared):
            raise ValueError(f"{out} lies on one machine only")
    return out


def _fs(path: str):
    """(filesystem, path inside it) for ``file:`` and other URIs."""
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    # one store, whatever connector Spark's name for it means
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


@dataclass
class _Commit(WriterCommitMessage):
    rows: int = 0
    files: tuple[str, ...] = ()


MANIFEST = "_manifest.json"


def _read_manifest(fs, root: str) -> dict | None:
    from pyarrow import fs as pafs

    if fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def _put_manifest(fs, root: str, files: list[str], rows: int) -> None:
    """One file put in place as a whole, by a rename or a store's copy of one object."""
    part = f"{root}/_manifest-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(json.dumps({"rows": rows, "files": files}).encode())
    fs.move(part, f"{root}/{MANIFEST}")


def _parquet_under(fs, root: str) -> list[str]:
    """Parquet files under ``root``, by their paths in it."""
    from pyarrow import fs as pafs

    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    files = [i.path[len(root) + 1 :] for i in found if i.type == pafs.FileType.File and i.base_name.endswith(".parquet")]
    return sorted(f for f in files if not f.startswith("_") and "/_" not in f)


class _Part:
    """One file of a task: batches are gathered into row groups of the size asked."""

    def __init__(self, fs, name: str, schema: pa.Schema, size: int, level: int):
        import pyarrow.parquet as pq

        self.schema, self.size, self.held, self.rows, self.total = schema, size, [], 0, 0
        self.writer = pq.ParquetWriter(fs.open_output_stream(name), schema, compression="zstd", compression_level=level)

    def add(self, table: pa.Table) -> None:
        self.held.append(table)
        self.rows += table.num_rows
        self.total += table.num_rows
        while self.rows >= self.size:
            whole = pa.concat_tables(self.held)
            self.writer.write_table(whole.slice(0, self.size), row_group_size=self.size)
            self.held, self.rows = [whole.slice(self.size)], self.rows - self.size

    def close(self) -> None:
        if self.rows:
            self.writer.write_table(pa.concat_tables(self.held), row_group_size=self.size)
        self.writer.close()


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = (options.get("path") or "").rstrip("/")
        if not self.path:
            raise ValueError("geoparquet sink needs a path")
        if not overwrite:
            raise ValueError("geoparquet sink writes whole outputs: use mode overwrite")
        self.geometry = options.get("geometry_column", "geometry")
        self.partition_by = options.get("partition_by")
        self.row_group_size = int(options.get("row_group_size", 131072))
        self.level = int(options.get("compression_level", 3))
        self.most = int(options.get("max_rows_per_file", 0)) or None
        self.geometry_types = json.loads(options.get("geometry_types", "[]"))
        self.job = options.get("job_id") or uuid.uuid4().hex

    def _schema(self, schema: pa.Schema) -> pa.Schema:
        fields = []
        for f in schema:
            if f.name == self.partition_by:
                continue
            fields.append(pa.field(f.name, WkbType(CRS_PROJJSON), f.nullable) if f.name == self.geometry else f)
        geo = {
            "version": GEO_VERSION,
            "primary_column": self.geometry,
            "columns": {self.geometry: {"encoding": "WKB", "geometry_types": self.geometry_types, "crs": CRS_PROJJSON}},
        }
        return pa.schema(fields, metadata={b"geo": json.dumps(geo).encode()})

    def _tables(self, batch: pa.RecordBatch):
        """(folder key, table with the geometry tagged) of a batch."""
        groups = [(None, batch)]
        if self.partition_by:
            keys = batch.column(self.partition_by)
            groups = []
            for k in pa.compute.unique(keys).to_pylist():
                mask = pa.compute.equal(keys, pa.scalar(k, keys.type)) if k is not None else pa.compute.is_null(keys)
                groups.append((k, batch.filter(mask)))
        for k, b in groups:
            schema = self._schema(b.schema)
            cols = [
                pa.ExtensionArray.from_storage(WkbType(CRS_PROJJSON), b.column(f.name).cast(pa.binary())) if f.name == self.geometry else b.column(f.name)
                for f in schema
            ]
            yield k, pa.Table.from_arrays(cols, schema=schema)

    def write(self, iterator):
        from pyspark import TaskContext

        _register_wkb_type()
        ctx = TaskContext.get()
        part, attempt = (ctx.partitionId(), ctx.taskAttemptId()) if ctx else (0, 0)
        fs, base = _fs(self.path)
        parts: dict = {}
        files: list[str] = []
        rows = 0
        for batch in iterator:
            if batch.num_rows == 0:
                continue
            rows += batch.num_rows
            for k, table in self._tables(batch):
                while table.num_rows:
                    if k not in parts:
                        folder = f"{self.partition_by}={k}/" if self.partition_by else ""
                        fs.create_dir(f"{base}/{folder}", recursive=True)
                        files.append(f"{folder}part-{part:05d}-{attempt}-{len(files):04d}-{self.job}.parquet")
                        parts[k] = _Part(fs, f"{base}/{files[-1]}", table.schema, self.row_group_size, self.level)
                    head = table.slice(0, self.most - parts[k].total) if self.most else table
                    parts[k].add(head)
                    table = table.slice(head.num_rows)
                    if parts[k].total == self.most:
                        parts.pop(k).close()
        for p in parts.values():
            p.close()
        return _Commit(rows=rows, files=tuple(files))

    def commit(self, messages) -> None:
        """The new files count from the moment their manifest is in place; then all others go."""
        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        _put_manifest(fs, base, files, sum(m.rows for m in messages if m))
        self.clear(fs, base, set(files))
        with fs.open_output_stream(f"{base}/_SUCCESS"):
            pass

    def clear(self, fs, base: str, keep: set[str]) -> None:
        for f in _parquet_under(fs, base):
            if f not in keep:
                fs.delete_file(f"{base}/{f}")

    def abort(self, messages) -> None:
        fs, base = _fs(self.path)
        for f in _parquet_under(fs, base):
            if f.endswith(f"-{self.job}.parquet"):
                fs.delete_file(f"{base}/{f}")


def _list_parquet(path: str) -> list[str]:
    """Files of the output that ``path`` is or, one level up, belongs to, sorted: those of its manifest;
    without one, the Parquet files under ``path``. ``path`` may be one file."""
    from pyarrow import fs as pafs

    fs, base = _fs(path)
    base = base.rstrip("/")
    if fs.get_file_info(base).type == pafs.FileType.File:
        return [base]
    for root in (base, base.rpartition("/")[0]):
        found = _read_manifest(fs, root)
        if found is not None:
            return sorted(f for f in (f"{root}/{f}" for f in found["files"]) if f.startswith(f"{base}/"))
    return [f"{base}/{f}" for f in _parquet_under(fs, base)]


def current_files(spark: SparkSession, path: str) -> list[str] | None:
    """Paths of the files that the manifest of the output at ``path`` names; None where there is no manifest."""
    path = qualified(spark, path).rstrip("/")
    found = _read_manifest(*_fs(path))
    return None if found is None else [f"{path}/{f}" for f in found["files"]]


def _hive_keys(base: str, file: str) -> dict[str, str]:
    rel = file[len(base):].strip("/").split("/")[:-1]
    return dict(part.split("=", 1) for part in rel if "=" in part)


_DDL = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float",
        "double": "double", "string": "string", "large_string": "string", "bool": "boolean",
        "binary": "binary", "large_binary": "binary"}


def _ddl(t: pa.DataType) -> str:
    if isinstance(t, pa.ExtensionType):
        return "binary"
    return _DDL.get(str(t), "string")


class _FilePartition(InputPartition):
    def __init__(self, file: str):
        super().__init__(file)
        self.file = file


class GeoParquetReader(DataSourceReader):
    """One partition per file; PyArrow reads it inside the task."""

    def __init__(self, options: dict, schema):
        self.path = options.get("path")
        self.schema = schema

    def partitions(self):
        return [_FilePartition(f) for f in _list_parquet(self.path)]

    def read(self, partition):
        import pyarrow.parquet as pq

        _register_wkb_type()
        fs, base = _fs(self.path)
        keys = _hive_keys(base, partition.file)
        names = [f.name for f in self.schema.fields]
        with fs.open_input_file(partition.file) as fh:
            pf = pq.ParquetFile(fh)
            file_cols = [n for n in names if n in pf.schema_arrow.names]
            for batch in pf.iter_batches(columns=file_cols):
                cols = []
                for n, f in zip(names, self.schema.fields):
                    if n in file_cols:
                        c = batch.column(n)
                        if isinstance(c.type, pa.ExtensionType):
                            c = c.storage
                        cols.append(c)
                    else:
                        raw = keys.get(n)
                        typ = pa.int32() if f.dataType.simpleString() == "int" else pa.string()
                        cols.append(pa.array([None if raw is None else (int(raw) if typ == pa.int32() else raw)] * batch.num_rows, typ))
                yield pa.RecordBatch.from_arrays(cols, names=names)


class GeoParquetDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def schema(self):
        """From the first file's footer (geometry as binary) plus folder keys."""
        import pyarrow.parquet as pq

        _register_wkb_type()
        path = self.options.get("path")
        files = _list_parquet(path)
        if not files:
            raise FileNotFoundError(path)
        fs, base = _fs(path)
        with fs.open_input_file(files[0]) as fh:
            sch = pq.ParquetFile(fh).schema_arrow
        cols = [f"`{f.name}` {_ddl(f.type)}" for f in sch]
        for k, v in _hive_keys(base, files[0]).items():
            if k not in sch.names:
                cols.append(f"`{k}` {'int' if v.lstrip('-').isdigit() else 'string'}")
        return ", ".join(cols)

    def reader(self, schema):
        return GeoParquetReader(self.options, schema)

    def writer(self, schema, overwrite: bool):
        return GeoParquetWriter(self.options, overwrite)


def read_geoparquet(spark: SparkSession, path: str) -> DataFrame:
    """Read GeoParquet (GEOMETRY logical type or WKB) as a DataFrame; the
    geometry comes back as WKB ``binary``, folder keys as columns."""
    register(spark)
    return spark.read.format("geoparquet").load(qualified(spark, path))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoParquetDataSource)


def write_geoparquet(df: DataFrame, path: str, partition_by: str | None = None, row_group_size: int = 131072,
                     geometry: str = "geometry", geometry_types=("Polygon", "MultiPolygon"),
                     max_rows_per_file: int | None = None) -> int:
    """Write ``df`` (already partitioned/sorted as wanted) as GeoParquet;
    returns the rows written. A task goes on in another file where one has ``max_rows_per_file``.

    Files go straight to their folders under names of their own, and no file is renamed. Readers
    of this module see the old output as a whole until the new manifest is in place and the new one from then on,
    wherever a run dies; the next run clears what is left over. One run at a time may write to a path.
    """
    spark = df.sparkSession
    register(spark)
    path = qualified(spark, path).rstrip("/")
    fs, base = _fs(path)
    if _read_manifest(fs, base) is None:
        # what is there until the commit, if anything
        fs.create_dir(base, recursive=True)
        _put_manifest(fs, base, _parquet_under(fs, base), 0)
    w = (
        df.write.format("geoparquet")
        .mode("overwrite")
        .option("geometry_column", geometry)
        .option("row_group_size", row_group_size)
        .option("max_rows_per_file", max_rows_per_file or 0)
        .option("geometry_types", json.dumps(list(geometry_types)))
        .option("job_id", uuid.uuid4().hex)
    )
    if partition_by:
        w = w.option("partition_by", partition_by)
    w.save(path)
    return _read_manifest(fs, base)["rows"]


def geo_footer(spark: SparkSession, path: str) -> DataFrame:
    """Per file: GeoParquet version, primary column, encoding, Arrow type, CRS,
    rows and the rows of its largest row group.

    Files are listed by Spark and footers read inside tasks (mapInArrow),
    so the driver never opens a data file.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    files = listing.load(current_files(spark, path) or path).select("path")

    def read_footers(batches):
        import pyarrow.parquet as pq

        _register_wkb_type()
        for b in batches:
            out = {k: [] for k in ("path", "version", "primary_column", "encoding", "geometry_type", "crs", "num_rows", "largest_group")}
            for p in b.column("path").to_pylist():
                fs, local = _fs(p)
                with fs.open_input_file(local) as fh:
                    pf = pq.ParquetFile(fh)
                    sch = pf.schema_arrow
                    nrows = pf.metadata.num_rows
                    largest = max((pf.metadata.row_group(i).num_rows for i in range(pf.metadata.num_row_groups)), default=0)
                geo = json.loads((sch.metadata or {}).get(b"geo", b"{}"))
                prim = geo.get("primary_column")
                col = geo.get("columns", {}).get(prim or "", {})
                out["path"].append(p)
                out["version"].append(geo.get("version"))
                out["primary_column"].append(prim)
                out["encoding"].append(col.get("encoding"))
                out["geometry_type"].append(str(sch.field(prim).type) if prim and prim in sch.names else None)
                crs = (col.get("crs") or {}).get("id") or {}
                out["crs"].append(f"{crs['authority']}:{crs['code']}" if crs else None)
                out["num_rows"].append(nrows)
                out["largest_group"].append(largest)
            yield pa.RecordBatch.from_pydict(out)

    schema = (
        "path string, version string, primary_column string, encoding string, geometry_type string, crs string, "
        "num_rows long, largest_group long"
    )
    return files.mapInArrow(read_footers, schema)


def write_index_v1(idx: DataFrame, path: str) -> None:
    """v1 layout per resolution: hex id, centre POINT (native GEOMETRY), lat,
    lon, area and the metrics, range partitioned and sorted by cell."""
    from tessera.operators.queries import to_v1

    v1 = to_v1(idx.repartitionByRange("h3_res", "h3_index").sortWithinPartitions("h3_res", "h3_index"))
    v1 = v1.withColumn("h3_res", (F.expr("CAST(conv(h3_index, 16, 10) AS BIGINT)") / (1 << 52)).cast("int"))
    write_geoparquet(v1, path, partition_by="h3_res", row_group_size=1_000_000, geometry_types=("Point",))
