"""Scans, generated spines and layer materialization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillbook import schemas


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """One table of a folder with its declared types; no inference over file footers."""
    return spark.read.schema(schema or schemas.SOURCE[name]).parquet(f"{folder}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, name: str, column: str, bounds: tuple[int, int], parts: int, **options):
    """Partitioned scan of a database table; the caller brings driver and credentials in options."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=name,
            partitionColumn=column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=parts,
            **options,
        )
        .load()
    )


def spine(spark: SparkSession, n: int, name: str = "i") -> DataFrame:
    """0 .. n-1 without a global window."""
    return spark.range(n).withColumnRenamed("id", name)


def materialize(df: DataFrame, kind: str, name: str, bucket_by: tuple[int, list[str]] | None = None) -> DataFrame:
    """Keep a layer as a view or as a table, optionally bucketed so later joins on the key co-locate."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization: {kind}")
    return spark.table(name)


def select_renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Keep exactly these columns under their new names."""
    return df.select([F.col(old).alias(new) for old, new in columns.items()])
