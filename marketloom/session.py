"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window stages are heavy on CPU and light on bytes: keep them spread over the cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Wide window plans generate more classes than the default cache of 100 holds.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Methods above 8000 bytes are never compiled by the JVM: better not to fuse such a stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; on a cluster a missing setting is an error, because
    executors on other machines could not read what was staged.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="marketloom-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set(CHECKPOINT_KEY, path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared working folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


# Tables staged by this process and not deleted yet.
_STAGED: list[str] = []


def release_staged(spark: SparkSession) -> None:
    """Delete the tables staged so far; a driver that runs on calls it between runs.

    Frames that read them are of no use afterwards.
    """
    while _STAGED:
        drop_path(spark, _STAGED.pop())


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """The rows written once below the shared folder and read back.

    Cuts lineage in a way that survives lost executors. It also gives the planner the true size
    of a small result, so that it broadcasts it when it is below the threshold and shuffles it
    when it is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the staged table that ``df``, a result of :func:`staged`, reads. Nothing may read it later."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, folder.removeprefix("file://"))


def _hadoop_path(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop_path(spark, path)
    return fs.exists(hpath)


def drop_beside(spark: SparkSession, path: str, suffix: str) -> None:
    """Delete the side table ``path + suffix`` of a table; suffixes begin with two underscores."""
    if not suffix.startswith("__"):
        raise ValueError(f"{suffix} does not name a side table")
    hpath, fs = _hadoop_path(spark, path + suffix)
    fs.delete(hpath, True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table made by :func:`scratch_path`."""
    if not path.startswith(work_root(spark)):
        raise ValueError(f"{path} is not below the working folder")
    hpath, fs = _hadoop_path(spark, path)
    fs.delete(hpath, True)
