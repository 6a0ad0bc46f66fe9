"""Input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered_as_given(df: DataFrame) -> DataFrame:
    """Column ``place``: the position of each row in an ordered result, so that the order can be compared."""
    place = F.row_number().over(Window.orderBy("__row")).cast("bigint")
    return df.withColumn("__row", F.monotonically_increasing_id()).withColumn("place", place).drop("__row")
