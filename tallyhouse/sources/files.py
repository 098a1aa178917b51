"""CSV and parquet access through Spark, on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.sources.storage import exists


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    """Typed scan without an inference pass; blanks around values are not part of them."""
    return spark.read.csv(
        path,
        schema=schema,
        header=header,
        enforceSchema=not header,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def read_csv_as_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every column as text, for inputs whose bad values must reach the cleaning step."""
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    return spark.read.csv(path, schema=text, header=True, enforceSchema=False)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The data set, or None when nothing was written there yet."""
    return spark.read.parquet(path) if exists(spark, path) else None


def append_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
