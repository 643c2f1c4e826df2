"""JSON, CSV and spreadsheet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One object or array a file."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_sheet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV, or a spreadsheet where its reader is installed."""
    if path.endswith((".xlsx", ".xls")):
        try:
            import openpyxl  # noqa: F401
        except ImportError as e:
            raise RuntimeError("spreadsheets need openpyxl") from e
        import pandas as pd

        return spark.createDataFrame(pd.read_excel(path))
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema else r).csv(path)


def backup(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
