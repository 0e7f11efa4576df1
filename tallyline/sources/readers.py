"""Reading the report inputs from Parquet or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyline.functions.text import blank_to_null
from tallyline.sources.schemas import LEDGER, TRIP_TABLES


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and ISO dates; a row that does not fit the schema fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


_BAD_LINE = "_bad_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV with a header that fit the schema, and ``file, line, reason`` of the others.

    Both together have one row for each line that is not empty. The reason names the first column whose text is no value of its type; a line
    without one has too many or too few columns.
    """
    loose = T.StructType([*schema.fields, T.StructField(_BAD_LINE, T.StringType())])
    rows = spark.read.schema(loose).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD_LINE).csv(path)
    # Spark converts the columns that a query needs; a line must not be good only because its bad column is not read.
    everything = ", ".join(f"CAST(`{field.name}` AS STRING)" for field in schema)
    rows = rows.filter(f"length(concat_ws('', {everything})) >= 0")
    texts = ", ".join(f"`{field.name}` STRING" for field in schema)
    rejected = rows.filter(F.col(_BAD_LINE).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(_BAD_LINE).alias("line"), *[F.col(field.name).alias(f"_own_{field.name}") for field in schema]
    )
    parsed = rejected.withColumn("_texts", F.from_csv("line", texts))
    reasons = [
        f"CASE WHEN _texts.`{field.name}` IS NOT NULL AND `_own_{field.name}` IS NULL "
        f"THEN concat('{field.name} is no {field.dataType.simpleString()}: ', _texts.`{field.name}`) END"
        for field in schema
    ]
    named = parsed.selectExpr("file", "line", f"coalesce({', '.join(reasons)}, 'number of columns') AS reason")
    return rows.filter(F.col(_BAD_LINE).isNull()).drop(_BAD_LINE), named


def write_csv(table: DataFrame, path: str) -> None:
    table.write.option("header", True).csv(path)


def read_trip_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One of the tables of the cab schema, by its name."""
    schema = TRIP_TABLES[name]
    return read_csv(spark, path, schema) if fmt == "csv" else spark.read.schema(schema).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The movement ledger from Parquet."""
    return as_ledger(spark.read.schema(LEDGER).parquet(path))


# Read as NULL where empty. Location and destination are only compared with non-empty literals, and
# stay as they are so that these comparisons reach the Parquet scan.
_BLANK_IS_NULL = {"LOCAL_TRANSACTION_ID", "LHMNR", "ARTNR", "CREATEDBY"}


def as_ledger(rows: DataFrame, *also: str) -> DataFrame:
    """Ledger columns in the declared types, with the empty-string rule of the source database, and the columns ``also``."""
    columns = list(also)
    for field in LEDGER:
        value = F.col(field.name)
        if not isinstance(rows.schema[field.name].dataType, T.VariantType):
            value = value.cast(field.dataType)
        columns.append((blank_to_null(value) if field.name in _BLANK_IS_NULL else value).alias(field.name))
    return rows.select(*columns)
