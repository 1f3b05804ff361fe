"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# For sessions built here; one that was built elsewhere keeps its own settings.
DEFAULTS = {
    # Split a hot key also in a join whose partitioning the next step would have reused.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Whole documents go through Arrow: 1,000 long ones are about 100 MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "martflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults.

    ``master`` stays unset on a cluster, where spark-submit names it. Extra
    settings are passed with dots written as double underscores, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors of a session that was started without it.

    Not needed where the package is installed on them or given by ``--py-files``.
    """
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="martflow-ship-")) / "martflow.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the folder named by ``spark.checkpoint.dir``.

    Written tables, stream checkpoints and ``DataFrame.checkpoint`` data go
    there, so every executor can read them and they outlive a lost one. Only a
    local session without the setting gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="martflow-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Remove what ``shared_dir`` has named and nothing has changed for so long; the number of entries removed.

    Run it from a scheduled job. Results that are still read lazily need their
    entries, so the age must exceed the longest job's.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        return 0
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(base)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = (time.time() - 3600 * older_than_hours) * 1000
    old = [
        entry.getPath() for entry in (files.listStatus(folder) if files.exists(folder) else [])
        if re.fullmatch(r".+-[0-9a-f]{32}", entry.getPath().getName()) and entry.getModificationTime() < limit
    ]
    return sum(bool(files.delete(path, True)) for path in old)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a small intermediate result to the shared folder and read it back.

    It is computed once however often it is used, survives a lost executor,
    and is planned with its real size afterwards: Catalyst broadcasts it if it
    is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
    otherwise, with both join sides plain exchanges that AQE can split.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
