"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
SHIPPED = "_gridspark_shipped"


def get_spark(app: str = "gridspark", master: str | None = None, shuffle_partitions: int | None = None,
              **conf: str) -> SparkSession:
    """Session with UTC wall clock and adaptive execution; everything else stays as the cluster sets it."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to all Python workers, once a context: grouped functions are unpickled there by module name."""
    context = spark.sparkContext
    if getattr(context, SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # the driver serves this file to the executors as long as it lives
    folder = tempfile.mkdtemp(prefix="gridspark-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "gridspark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    out.write(file, os.path.join("gridspark", os.path.relpath(file, root)))
    context.addPyFile(path)
    setattr(context, SHIPPED, True)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the session. A local session that names none uses its warehouse."""
    path = spark.conf.get(SHARED_DIR_CONF, None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_CONF} to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so a retried job cannot read half-written data."""
    return f"{shared_dir(spark).rstrip('/')}/gridspark/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
