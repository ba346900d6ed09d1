"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # INT96, the default, has no row-group statistics, so a time filter could not skip anything
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.python.filterPushdown.enabled": "true",
}

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "tidelog", master: str | None = None, **conf) -> SparkSession:
    """A session for tests and benches; on a cluster spark-submit supplies the settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings results depend on (UTC) and the ones skew handling relies on (AQE)."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package known to Python workers, wherever the driver was started. Once per application.

    The source's planner process unpickles before it looks at shipped files, so classes travel by value as well.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    cloudpickle.register_pickle_by_value(sys.modules["tidelog"])
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidelog-ship-")) / "tidelog.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this application.

    `spark.checkpoint.dir` names it on a cluster. A machine-local folder is used only for a local
    master, where every executor lives in this JVM.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/tidelog-{sc.applicationId}"
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tidelog-")
    return _local_dirs[sc.applicationId]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below `scratch_root`."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def durable_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` into the shared folder and read it back, so a lost executor cannot change what was seen.

    Columnar and compressed, and later steps read only the columns they need.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
