"""Landing-zone CSV sources (comma-delimited text with a header line).

Delimited text is read *by position*.  With a user schema and Spark's default
``enforceSchema=true`` the header names are ignored, so a file whose columns
are in a different order silently shifts values into the wrong columns.  The
readers here always pass the declared schema in file order *and*
``enforceSchema=false``, which makes Spark check the header against the
schema and fail on a mismatch instead of shifting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom import schema as S


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """A typed CSV source: header line skipped, no schema inference.

    ``mode``: PERMISSIVE turns unparsable fields into NULL (the behaviour of
    a delimited-text table); FAILFAST raises on the first malformed row.
    """
    return (spark.read
            .schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", mode)
            .csv(path))


def read_landing(spark: SparkSession, path: str, table: str, mode: str = "PERMISSIVE") -> DataFrame:
    """One of the three landing tables (customer_profiles, loan_applications,
    transactions) with its declared schema."""
    return read_csv(spark, path, S.SCHEMAS[table], mode)


RAW_LINE = "raw_line"


def read_checked(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A landing table with ``raw_line``: null for a good row, the line as it
    stands for a malformed one (its unreadable fields are NULL)."""
    schema = T.StructType([*S.SCHEMAS[table].fields, T.StructField(RAW_LINE, T.StringType())])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE).csv(path))


def write_landing(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """Write a domain table as landing CSV in declared file order (header on)."""
    from riskloom.sources.tables import conform

    conform(df, table).write.mode(mode).option("header", True).csv(path)
