"""Session helpers: a local session for tests and benches, and lineage cutting.

On a cluster the caller owns the session; nothing here overrides settings the
cluster already gives.  The checkpoint folder is read from ``spark.checkpoint.dir``
and only set (to a fresh temporary folder) when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a local session.  On a cluster size shuffle partitions to the data
# (AQE coalesces small ones) and keep the driver out of the data path.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    # Checkpoint files of dropped datasets are removed (training writes one per fit).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app: str = "strata",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    # Local Python workers find the package whatever the folder a script was started in;
    # on a cluster ship it (--py-files) or install it.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session (``spark.checkpoint.dir`` or an already set SparkContext
    checkpoint dir).  Only a local-mode session without one (tests, benches) gets
    a fresh temporary folder; on a cluster a machine-local folder would be wrong,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder on shared storage (e.g. the cluster's DFS)"
            )
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def persist_reliably(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Survives the loss of any executor (unlike caching or local checkpoints).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Folder:
    """A folder on the cluster's shared storage (any file system that Spark reads)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, jvm = path.rstrip("/"), spark._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def __truediv__(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self) -> list[str]:
        """What lies in the folder, in order; nothing if there is none."""
        if not self._fs.exists(self._at(self.path)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(self.path)))

    def publish(self, draft: str, name: str, keep: bool = False) -> bool:
        """Give a finished draft its name, in one step.  False if the name is taken (the
        draft then goes, unless it is to be kept)."""
        if not self._fs.exists(self._at(self / name)):
            if self._fs.rename(self._at(self / draft), self._at(self / name)):
                return True
            if not self._fs.exists(self._at(self / draft)):
                raise OSError(f"{self / draft} is gone")
        if not keep:
            self._fs.delete(self._at(self / draft), True)
        return False

    def delete(self, name: str | None = None) -> None:
        self._fs.delete(self._at(self / name if name else self.path), True)


class Scratch:
    """Tables and files that one piece of work writes under the shared checkpoint folder.

    Unlike a cache they survive lost executors without recomputation, and the lineage
    is cut.  ``release`` drops them with their files."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names, self.folders = spark, [], []
        folder = f"{checkpoint_dir(spark).rstrip('/')}/tables"
        self.database = f"strata_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex[:12]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{folder}'")

    def table(
        self,
        df: DataFrame,
        bucket_by: str | None = None,
        buckets: int | None = None,
        partition_by: str | None = None,
    ) -> DataFrame:
        """``df`` written as a Parquet table and read back.  With ``bucket_by`` the table
        is bucketed and sorted by that column, so later plans know its hash partitioning
        (joins and per-key steps on it need no shuffle)."""
        name = f"{self.database}.t_{uuid.uuid4().hex[:12]}"
        writer = df.write.mode("error")
        if bucket_by is not None:
            n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer = writer.bucketBy(n, bucket_by).sortBy(bucket_by)
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def folder(self, name: str) -> Folder:
        """A new folder beside the tables, for files."""
        self.folders.append(Folder(self.spark, f"{checkpoint_dir(self.spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex[:12]}"))
        return self.folders[-1]

    def release(self) -> None:
        while self.folders:
            self.folders.pop().delete()
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()} PURGE")
