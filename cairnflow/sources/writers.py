"""Writers: Parquet with a manifest, landing tables, versioned publication behind a pointer."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.operators.merge import table_digest


def write_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` and returns its manifest row (table_name, relative_path, n_rows, digest, n_files, n_bytes), read back from what was written."""
    path = os.path.join(folder, name)
    df.write.mode("errorifexists").parquet(path)
    spark = df.sparkSession
    back = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    size = files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
    return table_digest(back).crossJoin(size).select(F.lit(name).alias("table_name"), F.lit(path).alias("relative_path"), "n_rows", "digest", "n_files", "n_bytes")  # one row each


def write_landing(tables: dict[str, DataFrame], folder: str, run_id: str) -> DataFrame | None:
    """One Parquet folder per table that has rows, and the run's manifest beside them; None if nothing was written."""
    manifest = None
    for name, df in sorted(tables.items()):
        if not df.isEmpty():
            one = write_table(df, os.path.join(folder, run_id), name)
            manifest = one if manifest is None else manifest.unionByName(one)
    if manifest is not None:
        manifest.withColumn("run_id", F.lit(run_id)).coalesce(1).write.json(os.path.join(folder, run_id, "_manifest"))
    return manifest


def move_pointer(spark: SparkSession, folder: str, value: str, note: str = "") -> None:
    """Adds a pointer above all before it: one file, committed by a rename; nothing is deleted, so readers always find the old or the new one."""
    last = read_pointer(spark, folder)
    row = spark.createDataFrame([((last[0] if last else 0) + 1, value, note)], POINTER)
    row.coalesce(1).write.mode("append").json(os.path.join(folder, "_pointer"))


POINTER = "at long, value string, note string"


def read_pointer(spark: SparkSession, folder: str) -> tuple[int, str, str] | None:
    """(number, value, note) of the greatest pointer; None where there never was one."""
    try:
        row = spark.read.schema(POINTER).json(os.path.join(folder, "_pointer")).where("at IS NOT NULL").orderBy(F.desc("at"), F.desc("value")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return (row["at"], row["value"], row["note"]) if row else None


def publish(df: DataFrame, folder: str, generation: str) -> None:
    """Writes a new generation, then moves the pointer: readers see the old or the new one, whole, whenever the writer may fail."""
    df.write.mode("errorifexists").parquet(os.path.join(folder, f"generation={generation}"))
    move_pointer(df.sparkSession, folder, generation)


def activate(spark: SparkSession, folder: str, generation: str) -> None:
    """Moves the pointer to a generation that was written before, forward or back; raises if there is none."""
    spark.read.parquet(os.path.join(folder, f"generation={generation}"))
    move_pointer(spark, folder, generation)


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The generation that the pointer names."""
    found = read_pointer(spark, folder)
    if found is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(os.path.join(folder, f"generation={found[1]}"))


def publish_checked(tables: dict[str, DataFrame], counts: dict[str, int], folder: str, generation: str) -> None:
    """Publishes several tables as one: all are written and counted, and only if every count is the manifest's does the one pointer move."""
    for name, df in sorted(tables.items()):
        path = os.path.join(folder, f"generation={generation}", name)
        df.write.mode("errorifexists").parquet(path)
        n = df.sparkSession.read.parquet(path).count()
        if n != counts.get(name):
            raise ValueError(f"{name} has {n} rows, its manifest says {counts.get(name)}")
    if tables:
        move_pointer(next(iter(tables.values())).sparkSession, folder, generation)


def published_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the generation that the pointer names."""
    found = read_pointer(spark, folder)
    if found is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(os.path.join(folder, f"generation={found[1]}", name))


def retained(generations: DataFrame, name: str, at: str, newest: int, days: int, now: str, active: str) -> DataFrame:
    """Adds keep: the active generation, the newest ones, and those younger than ``days``."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(at), name))  # a handful of generations
    return generations.withColumn("keep", (F.col(name) == active) | (rank <= newest) | (F.datediff(F.lit(now).cast("date"), F.col(at).cast("date")) <= days))
