"""Session settings the engine relies on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches of whole texts: a thousand long ones still fit a worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def builder(master: str | None = None, app: str = "quire") -> SparkSession.Builder:
    """A session builder with the engine's settings; shuffle width is left to the cluster."""
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b.master(master) if master else b


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime settings to a session that somebody else made, and send it the engine's code."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once for each context.

    So it need not be installed there, nor does it matter in which folder the driver was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quire_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quire-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder, "quire_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._quire_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share. The cluster names it in spark.checkpoint.dir.

    Only where that is unset (tests, one machine) a temporary folder is made.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="quire-checkpoint-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` reliably: its rows are written as a table to the shared folder and read again.

    Used where one intermediate result feeds several branches. It survives the loss of executors, and the
    planner knows the table's real size, while a checkpoint carries the guess made before it was computed.
    The files go with ``forget``, at the latest when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quire-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    key = id(spark.sparkContext)
    if key not in _written:
        atexit.register(_forget_at_exit, spark)
    _written.setdefault(key, []).append(path)
    return back


_written: dict[int, list[str]] = {}


def forget(spark: SparkSession) -> None:
    """Delete the tables that ``cut`` has written in this session; results built on them can't be read afterwards."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    for path in _written.pop(id(sc), []):
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def _forget_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended already
        forget(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
