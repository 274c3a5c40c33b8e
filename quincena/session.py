"""Session helpers: building a local session and finding the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants. AQE re-plans joins and coalesces
# partitions from runtime statistics; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quincena",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when nothing is set (tests) make one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster is a cluster
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quincena-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (once for each application):
    functions that run in them import it by name, and a cluster's executors,
    or workers started in another folder, do not find the driver's copy."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name), "zip",
                                  os.path.dirname(package), name)
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for written
    intermediate tables, stream checkpoints and sinks."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quincena/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "table", files: int | None = None, by: list[str] | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut (a lost executor re-reads files instead of
    recomputing the plan) and later plans see real file sizes and can prune
    columns. With ``files``, rows are hash-distributed on ``by`` into that
    many files first, so later scans get that many parallel splits even when
    the source was a single file. Never a machine-local folder unless the
    session names one."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if files:
        df = df.repartition(files, *(by or []))
    df.write.mode("overwrite").parquet(path)
    # The schema is known: no footer-reading job, and NTZ columns stay NTZ.
    return spark.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, sized from the bytes the biggest job
    reads (bronze / history) and the cores available.

    Shuffle partitions start at ``input_bytes / target_partition_bytes`` (at
    least 3 waves of tasks) and AQE coalesces them from measured sizes, so
    small stages do not pay for the large ones; skewed partitions above
    ~5x the median are split. Scan splits stay at 128 MB so every core gets
    work on a many-file bronze.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        # Broadcasts only below this many bytes (dimensions are written, so their bytes are known).
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
