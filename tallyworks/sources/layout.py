"""Stored tables in folders by client and month, and filters that choose among these folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Ends the name of the column that holds the month (``yyyyMM``) of a digit-text date.
MONTH = "_month"


def write_layout(df: DataFrame, path: str, date: str | None = None, client: str = "mandt", mode: str = "errorifexists") -> None:
    """Store a table by client and, if ``date`` names its column of digit-text dates, by month.

    Rows are brought together by folder before the write, and folders with very many rows are split, so that
    neither many small files nor one writer for a large month come out.
    """
    keys = [client]
    if date is not None:
        df = df.withColumn(date + MONTH, F.substring(F.col(date).cast("string"), 1, 6))
        keys.append(date + MONTH)
    df.hint("rebalance", *keys).write.partitionBy(*keys).mode(mode).parquet(path)


def read_layout(spark: SparkSession, path: str, client: str = "mandt") -> DataFrame:
    """A table of :func:`write_layout`; client and months are texts, as leading zeros count."""
    found = spark.read.parquet(path).schema
    texts = [client, *[name + MONTH for name in found.names]]
    schema = StructType([StructField(f.name, StringType() if f.name in texts else f.dataType, f.nullable) for f in found])
    return spark.read.schema(schema).parquet(path)


def in_months(df: DataFrame, date: str, first: dt.date, last: dt.date | None = None) -> DataFrame:
    """Rows whose folder may hold dates from ``first`` to ``last``; all rows of a table that isn't stored by month.

    For use beside the filter on the date itself. Both bounds are known before the scan, so it lists no other folder.
    """
    month = date + MONTH
    if month not in df.columns:
        return df
    kept = df.filter(F.col(month) >= first.strftime("%Y%m"))
    return kept if last is None else kept.filter(F.col(month) <= last.strftime("%Y%m"))
