"""Readers of Parquet tables by folder and name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, columns: tuple[str, ...] | None = None, markets: tuple[str, ...] | None = None) -> DataFrame:
    """A table's scan, all of it or some columns and the rows of some markets; these and the filters and columns of later steps reach the scan."""
    d = spark.read.parquet(f"{folder}/{name}.parquet")
    d = d if markets is None else d.where(F.col("market").isin(*markets))
    return d if columns is None else d.select(*columns)
