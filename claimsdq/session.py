"""Session helpers: a local session for tests and bench, and the
checkpoint folder that cuts lineage.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, reliable file system).  Only a local
session without that setting gets a scratch folder of its own.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "claimsdq", extra: dict | None = None) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    * Scan splits of 512 MB: 100 TB of input is about 200k read tasks, and
      each task's batch stays far below executor memory.
    * Shuffles here are small (partial aggregates, a broadcast join, per-file
      metrics); the one large shuffle is the salted join fallback.  Start at
      about one partition per 2 GB of input and let AQE coalesce towards
      256 MB partitions and split skewed ones.
    """
    parts = max(200, input_bytes // (2 << 30))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }


def apply_unset(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set each key only where the submitted configuration does not name it."""
    given = spark.sparkContext.getConf()
    for k, v in conf.items():
        if not given.contains(k) and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session; a scratch folder is set only when it is unset and
    the master is one machine (tests, bench).  A cluster without the setting is
    an error: a machine-local folder would not survive the loss of an executor.
    A ``file:`` folder that a cluster names itself is taken at its word, as it
    may be a mount that all machines share.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception as e:  # Spark Connect: only the setting is at hand
        if not conf:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints") from e
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not (sc.master or "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="claimsdq-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint dir for a staged table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/staged/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application,
    so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"    # read by the driver's file server
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


class RunContext:
    """The staged tables of one run: written once under the checkpoint folder,
    shared by the run's steps and removed at its end.

    Without a context an operator still works; what it stages then stays until
    the checkpoint folder is cleaned, since its lazy result reads it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` and read it back with the written types."""
        path = staging_path(self.spark, name)
        self.paths.append(path)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())

    def __enter__(self) -> "RunContext":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right under ``path``."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return [str(f.getPath().toString()) for f in found if f.isDirectory()]


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file over another, as an upload under its name does."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)


def modified_before(spark: SparkSession, path: str, millis: float) -> bool:
    """Whether nothing in a folder was written at or after a time (epoch ms)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(conf).listFiles(p, True)
    while files.hasNext():
        if files.next().getModificationTime() >= millis:
            return False
    return True


def file_times(spark: SparkSession, paths: list[str]) -> list[dt.datetime | None]:
    """Modification times of single files (None where there is none), looked up
    one by one without listing any folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def one(path: str) -> dt.datetime | None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return None
        return dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(milliseconds=fs.getFileStatus(p).getModificationTime())

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(one, paths))
