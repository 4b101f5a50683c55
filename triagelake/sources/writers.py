"""Writers: parquet pools, JSON and CSV results, and the evaluation report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON texts."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


# doubled quotes and kept blanks: any text survives a round trip
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns as JSON texts."""
    flat_for_csv(df).write.mode("overwrite").options(**_CSV).option("quoteAll", True).csv(path)


def read_csv(spark, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).option("multiLine", True).csv(path)
