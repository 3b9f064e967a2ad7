"""Session helpers: one place for the settings the plans rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of materialised intermediates are removed once the
    # job no longer references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "stonefly",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a local scratch folder
    is only created when the setting is absent (tests, laptops).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server owns the folder
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="stonefly-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def cut_lineage(df):
    """Materialise ``df`` with a reliable checkpoint in the shared folder
    (``spark.checkpoint.dir``): later passes read it instead of recomputing
    the whole upstream plan, and a lost executor cannot lose it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_table(df, name: str):
    """``df`` written once as Parquet under a new name in the shared folder
    (two runs never meet), and the plan that reads it back."""
    import uuid
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which a query's shuffle files are deleted when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class ScratchSteps:
    """Tables that one run writes between its steps, in a new folder under the
    shared one (``spark.checkpoint.dir``).

    A step's shuffle files go as its table is written, and a table goes when
    the run drops it: what lies on the disks is that of one step and the
    tables it reads, not of all steps together.
    """

    def __init__(self, spark: SparkSession, name: str):
        import uuid
        self.spark = spark
        self.folder = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def write(self, df, name: str):
        """``df`` written once under ``name``, and the plan that reads it back."""
        conf = self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP, None)
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        finally:
            conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads; without names, all of them."""
        try:
            sc = self.spark.sparkContext
        except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server owns the folder
            return
        for folder in [f"{self.folder}/{n}" for n in names] or [self.folder]:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
