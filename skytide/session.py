"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

RUNTIME_CONF = {
    # Alert times are absolute; every text form of them is UTC.
    "spark.sql.session.timeZone": "UTC",
    # year=2024/month=01 must read back as the text "01".
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Cutouts make rows wide: keep the batches handed to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}

_scratch_roots: dict[str, str] = {}
_shipped: set[str] = set()
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staged_paths", default=())


def build_session(app_name: str = "skytide", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to any session, and give
    its Python workers this package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers once per application, through the shared
    folder, so that no node needs it installed. Without such a folder on a
    cluster, give it to ``spark-submit --py-files``."""
    app = spark.sparkContext.applicationId
    package = os.path.dirname(os.path.abspath(__file__))
    if app in _shipped or not os.path.isdir(package):  # a zip given by --py-files
        return
    _shipped.add(app)
    try:
        target = scratch_path(spark, "package") + ".zip"
    except RuntimeError:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    filesystem, inner = open_filesystem(target)
    filesystem.create_dir(os.path.dirname(inner))
    with filesystem.open_output_stream(inner) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(target)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables, from ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, because executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return qualified(spark, root)
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _scratch_roots[app] = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(_scratch_roots[app])
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root; never reused, so never overwritten."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and fixes its rows.

    Inside a ``staging_scope`` the table goes with the scope; one to be kept goes with
    the scope around that one, if there is any.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    scopes = _scopes.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope():
    """Drop the tables staged inside the block when it ends.

    For code that has written its results by then (or stages them to be kept), so
    that steps that are over do not fill the scratch folder.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            filesystem, inner = open_filesystem(path)
            if filesystem.get_file_info(inner).type == pafs.FileType.Directory:
                filesystem.delete_dir(inner)


def small_table(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    """A driver-side table as a local relation, so Spark knows its true size."""
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(struct)), struct)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a narrow lookup table, given only after counting it.

    Beyond ``max_rows`` the frame is returned unchanged and Spark shuffles the
    join (with adaptive skew handling) instead.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def read_table_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False):
    """The Parquet table at ``path``, or None when nothing was written yet."""
    try:
        reader = spark.read.option("mergeSchema", merge_schema)
        reader = reader if schema is None else reader.schema(schema)
        return reader.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def qualified(spark: SparkSession, path: str) -> str:
    """A path as every machine of the cluster understands it: one without a scheme
    lies on Spark's default file system, not on the disk of whoever opens it."""
    if len(urlparse(path).scheme) > 1:
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if default.startswith("file:"):
        return path
    return f"{default.rstrip('/')}/{path.lstrip('/')}"


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path for a local path or a URI (``s3://``, ``hdfs://`` …)."""
    scheme = urlparse(path).scheme
    if scheme in ("s3a", "s3n"):  # Spark's names for what Arrow calls s3
        path = "s3" + path[len(scheme) :]
    if len(scheme) > 1:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def has_kafka(spark: SparkSession) -> bool:
    """Whether the Kafka connector is on the session's class path."""
    jvm = spark.sparkContext._jvm
    loader = jvm.Thread.currentThread().getContextClassLoader()
    try:
        jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider", False, loader)
        return True
    except Exception:  # py4j wraps ClassNotFoundException
        return False
