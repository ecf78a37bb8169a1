"""Access to the parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.sources import contacts


class Tables:
    """Lazy table access: ``Tables(spark, path).events`` is a plain parquet scan.

    Wall-clock columns are read as session-zone timestamps, whichever timestamp
    flavour the files carry.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        naive = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    def contact_days(self) -> DataFrame:
        return contacts.contact_days(self.events)

    def contacts(self, *columns: str) -> DataFrame:
        """The bronze contact table derived from customers and their events; all columns or those named."""
        return contacts.contacts(self.customer, self.nation, self.region, self.events, columns)
