"""Parquet table source (the driver's test tables, or any table folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``{base_dir}/{name}.parquet``; selecting ``columns`` prunes the scan."""
    df = spark.read.parquet(f"{base_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
