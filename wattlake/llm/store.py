"""Side files in the cluster's shared folder.

Tasks put whole, deterministic files (one per task or shard) under
``spark.checkpoint.dir`` and later tasks read or memory-map them.  A file is
written under a private name and renamed, so a retried or speculative task
leaves the same file.  Any file system that ``pyarrow.fs`` knows works (local
or mounted paths, HDFS, object stores); a file that is not on a mounted path is
copied to an unnamed local file before it is mapped, which vanishes with the
worker.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from wattlake.session import scratch_dir


def new_store(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder in the shared checkpoint folder."""
    ship(spark)
    return scratch_dir(spark, name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import wattlake
    import zipfile
    root = os.path.dirname(os.path.abspath(wattlake.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="wattlake-ship-"), "wattlake.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def put(store: str, name: str, data: bytes) -> None:
    fs, base = _fs(store)
    folder = os.path.dirname(f"{base}/{name}")
    fs.create_dir(folder, recursive=True)
    tmp = f"{folder}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, f"{base}/{name}")


def get(store: str, name: str) -> bytes | None:
    """Content, or None if there is no such file."""
    fs, base = _fs(store)
    if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def put_arrays(store: str, name: str, **arrays: np.ndarray) -> None:
    """One ``.npy`` file per array (name-key.npy)."""
    for key, a in arrays.items():
        buf = io.BytesIO()
        np.save(buf, a)
        put(store, f"{name}-{key}.npy", buf.getbuffer())


def map_array(store: str, name: str, key: str) -> np.ndarray:
    """A memory-mapped array written by :func:`put_arrays`."""
    fs, base = _fs(store)
    path = f"{base}/{name}-{key}.npy"
    if isinstance(fs, pafs.LocalFileSystem):
        return np.load(path, mmap_mode="r")
    with fs.open_input_stream(path) as src, tempfile.TemporaryFile() as own:
        while block := src.read(1 << 22):
            own.write(block)
        own.flush()
        own.seek(0)
        version = np.lib.format.read_magic(own)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, _, dtype = read(own)
        if not shape[0]:
            return np.zeros(0, dtype)
        return np.memmap(own, dtype, "r", own.tell(), shape)


def put_table(store: str, folder: str, name: str, table: pa.Table) -> None:
    buf = io.BytesIO()
    pq.write_table(table, buf)
    put(store, f"{folder}/{name}.parquet", buf.getbuffer())


def read_table(spark: SparkSession, store: str, folder: str, schema: str) -> DataFrame:
    """The files of :func:`put_table` (no rows if no task wrote one)."""
    fs, base = _fs(store)
    if fs.get_file_info(f"{base}/{folder}").type == pafs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store}/{folder}")


def saved(df: DataFrame, store: str, name: str) -> DataFrame:
    """Cut the lineage: written to the shared folder and read again."""
    df.write.mode("overwrite").parquet(f"{store}/{name}")
    return df.sparkSession.read.parquet(f"{store}/{name}")


def scanned(docs: DataFrame, store: str) -> DataFrame:
    """``docs`` as a plain file scan, whose partitions hold the same rows on every pass.

    A frame that already is one (a scan and projections) is returned as it
    is; any other plan is written to the shared folder first.
    """
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() in ("Project", "SubqueryAlias"):
        if "nondeterministic" in plan.toString().lower():
            break
        plan = plan.children().head()
    if plan.getClass().getSimpleName() == "LogicalRelation":
        return docs
    return saved(docs, store, "input")


def shards_of(df: DataFrame) -> int:
    """Number of shards of keyed intermediate data: the session's shuffle partitions."""
    return max(4, min(60000, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
