"""Session helpers: a local session for tests and the bench, and the shared
folder (``spark.checkpoint.dir``) that jobs write staged data to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Run-time settings the operators rely on.
#  - LAST_WIN: a later duplicate map key replaces the earlier one (URL
#    parameters, envelope attributes merged over record attributes).
#  - UTC: timestamps print the same everywhere.
RUNTIME_CONF = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def get_session(master: str | None = None, app: str = "rivulet",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIVULET_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it: a folder of the driver's machine is not seen by
    the executors. Only a local session without one gets a temporary folder
    (tests). A checkpoint folder that the user has set is left alone.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder for staged tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{root}/rivulet/{leaf}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint folder and reading it back (one job; columnar; survives lost
    executors, since later stages read the files, not recomputed tasks)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
