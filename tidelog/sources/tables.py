"""The batch result tables and their database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.schema import BATCH_TABLES

# How a CSV result file is written and read. An empty text stays apart
# from a missing value, and blanks around a text are kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": "\\",
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_batch_tables(
    spark: SparkSession, path: str, file_format: str = "parquet"
) -> dict[str, DataFrame]:
    """The seven aggregates below ``path``, Parquet or CSV with a header line."""
    tables = {}
    for name, schema in BATCH_TABLES.items():
        reader = spark.read.schema(schema)
        if file_format == "csv":
            reader = reader.options(**CSV_OPTIONS)
        tables[name] = reader.format(file_format).load(f"{path}/{name}")
    return tables


def create_database(
    spark: SparkSession, database: str, path: str, file_format: str = "parquet"
) -> None:
    """Catalogue the result folders as external tables of one database."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} "
        "COMMENT 'Historical access-log analytics'"
    )
    options = ""
    if file_format == "csv":
        listed = ", ".join(
            f"{key} '{value}'".replace("\\", "\\\\") for key, value in CSV_OPTIONS.items()
        )
        options = f"OPTIONS ({listed})"
    for name, schema in BATCH_TABLES.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE {database}.{name} ({schema}) USING {file_format} {options} "
            f"LOCATION '{path}/{name}'"
        )
