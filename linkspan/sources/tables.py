"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def records(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One row per entity_id of a source table; rows without an id are no records.

    Repeated deliveries carry the same four columns, so taking each combination once is enough.
    """
    return table(spark, directory, name).select(*SOURCE_COLUMNS).where("entity_id is not null").distinct()
