"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelog.operators.aggregates import in_output_order
from tidelog.sources.tables import CSV_OPTIONS


def write_table(
    table: DataFrame, path: str, file_format: str = "parquet", single_file: bool = False
) -> None:
    """Replace the table at ``path``. CSV files get a header line.

    ``single_file`` is for small tables that people read.
    """
    if single_file:
        table = table.coalesce(1)
    options = CSV_OPTIONS if file_format == "csv" else {}
    table.write.mode("overwrite").format(file_format).options(**options).save(path)


def write_batch_results(
    results: dict[str, DataFrame],
    path: str,
    file_format: str = "parquet",
    ordered: bool = False,
    single_file: bool = False,
) -> None:
    """One folder per aggregate. Ordering costs a sort of every table."""
    for name, table in results.items():
        shown = in_output_order(name, table) if ordered else table
        write_table(shown, f"{path}/{name}", file_format, single_file)


def write_data_quality(quality: DataFrame, path: str, file_format: str = "parquet") -> None:
    write_table(quality, f"{path}/data_quality", file_format)


def write_rejected(
    breakdown: DataFrame, sample: DataFrame, path: str, file_format: str = "parquet"
) -> None:
    write_table(breakdown, f"{path}/rejected_breakdown", file_format)
    write_table(sample, f"{path}/rejected_sample", file_format)


def write_serving_view(view: dict[str, DataFrame], path: str) -> None:
    """Every section of the serving view as a table of its own below ``path``."""
    for section, table in view.items():
        write_table(table, f"{path}/{section}")


def write_view_lines(lines: DataFrame, path: str) -> None:
    """The view as JSON rows, one folder per section, sorted by key within files."""
    (
        lines.sortWithinPartitions("section", "key")
        .write.mode("overwrite")
        .partitionBy("section")
        .json(path)
    )
