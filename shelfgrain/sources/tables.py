"""Warehouse tables: review scan and date-partitioned results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.shaping import valid_for_scoring


def read_table(spark: SparkSession, path_or_table: str) -> DataFrame:
    """A catalog table, or a Parquet folder if the name looks like a path."""
    return spark.read.parquet(path_or_table) if "/" in path_or_table else spark.table(path_or_table)


def read_reviews(spark: SparkSession, path_or_table: str) -> DataFrame:
    """Reviews fit for scoring; the filter and the selected columns reach the scan."""
    return valid_for_scoring(read_table(spark, path_or_table))


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append", rows_per_file: int = 5_000_000) -> None:
    """Write rows below one folder per partition value.

    'overwrite' replaces only the partitions present in the rows, so a job can run again.
    Rows stay where they are: a run date is one value, and every task writes its own file.
    """
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
        .parquet(path)
    )
