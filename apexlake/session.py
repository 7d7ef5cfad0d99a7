"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Of tables with whole pages in a row. Readers take up to 4,096 rows of a row group into memory at once; at 1 MB, compressed, some hundred pages.
LARGE_ROWS = {"parquet.block.size": 1 << 20}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on. On a cluster, leave ``master`` unset."""
    builder = SparkSession.builder.appName("apexlake").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    The time zone changes results (it decides the calendar day of a UTC start),
    so it is pinned; skew handling and partition coalescing need AQE.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; a folder set on the
    context counts too. A temporary folder is only chosen in local mode, where
    driver and executors share one disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="apexlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def _on_store(spark: SparkSession, name: str):
    """A path and the file system it lies on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it lies."""
    path, store = _on_store(spark, folder)
    store.delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    path, store = _on_store(spark, folder)
    return sorted(entry.getPath().getName() for entry in store.listStatus(path)) if store.exists(path) else []


def read_if_there(spark: SparkSession, schema, folder: str) -> DataFrame | None:
    """Parquet files under a folder; None if nothing has been written there yet."""
    return spark.read.schema(schema).parquet(folder) if names_in(spark, folder) else None


def claim(spark: SparkSession, name: str) -> bool:
    """Create an empty file; False if it is there already. Of several writers one succeeds."""
    path, store = _on_store(spark, name)
    return not store.exists(path) and store.createNewFile(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own under the shared one."""
    return f"{shared_folder(spark)}/written/{label}-{uuid.uuid4().hex}"


def write_at(df: DataFrame, folder: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` to a folder and read it back."""
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)


def write_once(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage with files that outlive an executor, and gives the reader
    real file sizes, which is what Spark's broadcast threshold checks.
    """
    return write_at(df, new_folder(df.sparkSession, label), partition_by, **options)
