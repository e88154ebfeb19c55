"""Session settings and the shared scratch folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on.

    All hours and minutes are UTC, and a JSON object with a repeated key keeps the
    last value instead of being unreadable.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def build_session(name: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table written between two jobs.

    It lies in the shared folder of the cluster, ``spark.checkpoint.dir``. Only a
    local session may do without that setting; its folder is then below the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/tidelog/{name}-{uuid4().hex}"


def stage(table: DataFrame, name: str) -> DataFrame:
    """Write a table that several results need to the shared folder, and read it back.

    What follows starts from files instead of from the whole history of the table, also
    when executors are lost.
    """
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if there is no such folder."""
    files, place = file_system(spark, path)
    return sorted(found.getPath().getName() for found in files.listStatus(place)) if files.exists(place) else []


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does any path look like the pattern?"""
    files, place = file_system(spark, pattern)
    return bool(files.globStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)
