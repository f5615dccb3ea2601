"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from ordermill.settings import Settings

WORK_DIR = "spark.ordermill.work.dir"
_shipped: set[str] = set()


def build_session(settings: Settings | None = None, master: str | None = None) -> SparkSession:
    """A session with the settings the jobs are written for.

    Broadcasts are never forced: a side is broadcast only when Spark finds it below
    ``broadcast_limit``, else the join shuffles and AQE splits hot partitions. Forcing the
    skew split keeps it when a later join reuses the same partitioning.
    """
    s = settings or Settings()
    b = SparkSession.builder.appName(s.app_name)
    if master:
        b = b.master(master)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": s.broadcast_limit,
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        b = b.config(key, value)
    if s.shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(s.shuffle_partitions))
    if s.work_dir:
        b = b.config(WORK_DIR, s.work_dir)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def size_shuffles(
    spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20, growth: float = 3.0
) -> int:
    """Raises the number of shuffle partitions to what the input needs; returns it.

    AQE merges partitions that turn out small and cannot split those of a plain shuffle, so
    the number must come from the data. ``growth`` is rows in a shuffle against rows in
    compressed files. The number is never lowered.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(now, int(input_bytes * growth / partition_bytes) + 1)
    if needed > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return needed


def work_root(spark: SparkSession) -> str:
    """Where this application keeps what it writes between steps: a folder of its own below the one
    the cluster names in ``spark.checkpoint.dir``, else below ``spark.ordermill.work.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_DIR, None)
    if not shared:
        raise RuntimeError(f"set spark.checkpoint.dir (or {WORK_DIR}) to a folder all executors share")
    return f"{shared.rstrip('/')}/ordermill-{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove_work(spark: SparkSession, folder: str | None = None) -> None:
    """Removes a work folder, or all this application has written between steps. To be called when
    nothing that reads from it is needed any more."""
    root = work_root(spark)
    folder = folder or root
    if folder != root and not folder.startswith(f"{root}/"):
        raise ValueError(f"{folder} is no work folder of this application")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the executors, whose Python may not find it by itself. Once an
    application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    # The file has to last: executors fetch it when they start.
    folder = tempfile.mkdtemp(prefix="ordermill-")
    atexit.register(shutil.rmtree, folder, True)
    file = f"{folder}/ordermill.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, source.relative_to(home.parent))
    context.addPyFile(file)
    _shipped.add(context.applicationId)
