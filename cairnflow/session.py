"""Session, table access and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_cuts: list[str] = []


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "cairnflow") -> SparkSession:
    """A session for one machine; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``base``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by spark.checkpoint.dir.

    Where the session leaves it unset (a test on one machine), a temporary folder is
    made and removed at exit; on a cluster the setting must exist.
    """
    context = spark.sparkContext
    found = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF) or context.getCheckpointDir()
    if found:
        return found
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cairnflow-")
    atexit.register(shutil.rmtree, path, True)
    context.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    One computation, columnar, prunable, and readable after the loss of any executor.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"cut-{uuid.uuid4().hex}")
    _cuts.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Removes the tables that cut() has written in this process and returns their number: for long sessions, once no result that rests on them is read any more."""
    n = len(_cuts)
    while _cuts:
        path = spark._jvm.org.apache.hadoop.fs.Path(_cuts.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
