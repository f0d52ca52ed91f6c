"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  Adaptive execution sizes shuffle partitions, splits hot
# join keys and turns a join into a broadcast only after it has measured the small side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A join on (user, item) may use a partitioning by user.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app_name: str = "basketry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; ``master`` stays with spark-submit when unset.

    On a cluster leave ``shuffle_partitions`` unset and give a high
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` instead: adaptive
    execution then merges partitions down to the advisory size per shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a master whose tasks all run in this process may fall back to a folder of this
    machine; a cluster of worker processes on one machine is a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="basketry-checkpoint-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are in shared storage when this returns."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the code of this package with the session's jobs, once per application.

    Task functions can then be imported by workers that do not have the package; the archive
    travels as a file given with --py-files does. A package that came that way stays as it is.
    """
    sc = spark.sparkContext
    package = Path(__file__).resolve().parent
    if sc.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="basketry-code-")) / "basketry_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
