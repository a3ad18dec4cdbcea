"""Session defaults and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_written: list[str] = []
_own: list[str] = []


def build_session(app: str = "derlem", master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A session with adaptive execution on; master None leaves it to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def share_package(spark: SparkSession) -> None:
    """Let Python workers import derlem from where the driver did, whatever their working directory.

    Clusters whose machines do not share that path install the package or submit it with --py-files.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only where that is unset (local tests) an own one is made."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="derlem-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return "file://" + _own[0]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: later uses neither recompute it nor
    depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process has materialized, once no result that reads them is needed; says how many."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n


def default_data_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
