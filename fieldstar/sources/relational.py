"""Whole tables of a relational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Read one table over JDBC, or its Parquet extract when `url` is a folder.

    With a numeric partition column and its bounds the table is read by
    several tasks; rows outside the bounds are still read.
    """
    if not url.startswith("jdbc:"):
        return spark.read.parquet(f"{url.rstrip('/')}/{table}")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()
