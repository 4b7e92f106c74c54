"""Session settings and durable scratch space."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Session setting for tests and benchmarks: deal small given files, each one task, out over so many.
SPREAD = "spark.mailsieve.spread"
#: Bytes of an Arrow batch.  Spark's own bound is many times that, and every task holds a batch in the JVM, where the
#: buffers double as they grow, and one in Python.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "mailsieve", cpus: int | None = None, memory: str = "16g") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own session."""
    n = cpus or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config(SPREAD, str(n))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only when that is unset and the master is local (tests
    on one machine) is a fresh local folder used; elsewhere executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="mailsieve-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, so a lost executor loses nothing.

    The folder stays until ``release`` or whoever owns the scratch folder deletes it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for ``df``; nothing may read it any more."""
    path = getattr(df, "_cut_path", None)
    if path:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches hold about BATCH_BYTES from now on, unless it sets a bound itself."""
    conf = df.sparkSession.conf
    if _BATCH_SETTING not in conf.getAll:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver was started.

    Needed only when the package is not installed on the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_mailsieve_shipped", False):
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="mailsieve-pkg-")) / "mailsieve"
    sc.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
    sc._mailsieve_shipped = True
