"""Ledger tables laid out for their reports: by day for time windows, by transaction for strict pairing."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyline.functions.calendar import DAY_COLUMN
from tallyline.functions.json_fields import sound_variant
from tallyline.sources.readers import as_ledger
from tallyline.sources.schemas import LEDGER

# A transaction with more legs than this is not bucketed.
HEAVY_LEGS = 1_000_000
_TXN = "LOCAL_TRANSACTION_ID"


def write_ledger_by_day(ledger: DataFrame, path: str) -> None:
    """The ledger partitioned by the day of ``CREATED``; Spark splits large days into files of its usual size."""
    rows = ledger.select(*LEDGER.names).withColumn(DAY_COLUMN, F.to_date("CREATED"))
    rows.hint("rebalance", DAY_COLUMN).write.partitionBy(DAY_COLUMN).parquet(path)


def read_ledger_by_day(spark: SparkSession, path: str) -> DataFrame:
    """The ledger with its day, by which :func:`window_filter` reads the days of a window only."""
    schema = T.StructType([*LEDGER.fields, T.StructField(DAY_COLUMN, T.DateType())])
    return as_ledger(spark.read.schema(schema).parquet(path), DAY_COLUMN)


_WITH_VARIANTS = T.StructType(
    [T.StructField(field.name, T.VariantType() if field.name == "CUST_DATA" else field.dataType) for field in LEDGER]
)


def write_ledger_with_variants(ledger: DataFrame, path: str) -> None:
    """The ledger with its documents parsed once; documents that are not sound become NULL."""
    sound_variant(ledger.select(*LEDGER.names), "CUST_DATA").select(*LEDGER.names).write.parquet(path)


def read_ledger_with_variants(spark: SparkSession, path: str) -> DataFrame:
    """The ledger for the reports, which read paths of its documents and parse none."""
    return as_ledger(spark.read.schema(_WITH_VARIANTS).parquet(path))


@dataclass(frozen=True)
class BucketedLedger:
    """The legs of usual transactions, bucketed; those of transactions too large for one bucket, if there are any; and those of none."""

    light: DataFrame
    heavy: DataFrame | None
    unknown: DataFrame


def _table_name(path: str) -> str:
    return f"ledger_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _bucketed_table(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The files at ``path`` as a table of the session's catalog: a path alone does not tell of its buckets."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in LEDGER)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY ({_TXN}) SORTED BY (SEQUENCE) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(_table_name(path))


def write_bucketed_ledger(ledger: DataFrame, path: str, buckets: int, heavy_legs: int = HEAVY_LEGS) -> BucketedLedger:
    """The ledger in ``buckets`` files by transaction, each sorted by sequence, below ``path``.

    Legs of a transaction with more than ``heavy_legs`` rows would make one bucket larger than the rest, and so would those without
    a transaction; both go to plain tables of their own. There are at most rows / ``heavy_legs`` such transactions.
    """
    spark = ledger.sparkSession
    rows = ledger.select(*LEDGER.names)
    counted = rows.groupBy(_TXN).agg(F.count(F.lit(1)).alias("_legs"))
    counted.filter((F.col("_legs") > heavy_legs) & F.col(_TXN).isNotNull()).select(_TXN).write.parquet(f"{path}/heavy-transactions")
    heavy = spark.read.schema(T.StructType([LEDGER[_TXN]])).parquet(f"{path}/heavy-transactions")
    rows.filter(F.col(_TXN).isNull()).write.parquet(f"{path}/unknown")
    light = rows.dropna(subset=[_TXN])
    if not heavy.isEmpty():
        light.join(heavy, _TXN, "left_semi").select(*LEDGER.names).write.parquet(f"{path}/heavy")
        light = light.join(heavy, _TXN, "left_anti").select(*LEDGER.names)
    _bucketed_table(spark, f"{path}/light", buckets)
    light.repartition(buckets, _TXN).write.insertInto(_table_name(f"{path}/light"))
    return read_bucketed_ledger(spark, path, buckets)


def read_bucketed_ledger(spark: SparkSession, path: str, buckets: int) -> BucketedLedger:
    """What :func:`write_bucketed_ledger` has written, with as many buckets; blanks were NULL when it was written."""

    def plain(name: str) -> DataFrame:
        return spark.read.schema(LEDGER).parquet(f"{path}/{name}")

    try:
        heavy = plain("heavy")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        heavy = None
    return BucketedLedger(_bucketed_table(spark, f"{path}/light", buckets), heavy, plain("unknown"))
