"""Named input tables and inline constant tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.layout import read_layout


def snake(name: str) -> str:
    """``Storage Location`` -> ``storage_location``."""
    return re.sub(r"\W+", "_", name.strip().lower()).strip("_")


class Sources:
    """Looks up input tables by their lower-case base name.

    Column names are brought to snake_case, so views with display names and plain tables
    read alike. Nothing is read before a report runs; filters and column selection of the
    report reach the scan.
    """

    def __init__(self, spark: SparkSession, lookup: Callable[[str], DataFrame], client: str = "300"):
        self.spark = spark
        self._lookup = lookup
        self.client = client
        self._seen: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, client: str = "300") -> Sources:
        """One parquet file or folder per table under ``root``."""
        return cls(spark, lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet"), client)

    @classmethod
    def from_layout(cls, spark: SparkSession, root: str, client: str = "300") -> Sources:
        """Tables stored by client and month under ``root``, see :mod:`tallyworks.sources.layout`; others as they are."""
        return cls(spark, lambda name: read_layout(spark, f"{root.rstrip('/')}/{name}"), client)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str] | str, client: str = "300") -> Sources:
        """Catalog tables: a schema name, or a mapping from base name to full name."""
        if isinstance(names, str):
            return cls(spark, lambda name: spark.table(f"{names}.{name}"), client)
        return cls(spark, lambda name: spark.table(names[name]), client)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame], client: str = "300") -> Sources:
        return cls(spark, lambda name: frames[name], client)

    def table(self, name: str) -> DataFrame:
        if name not in self._seen:
            df = self._lookup(name)
            self._seen[name] = df.toDF(*[snake(c) for c in df.columns])
        return self._seen[name]

    def client_table(self, name: str) -> DataFrame:
        """Rows of the configured client only; a partition filter where stored so."""
        return self.table(name).filter(F.col("mandt") == self.client)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def inline(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """A constant table. Its size is known to the optimizer, so joins with it broadcast."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
