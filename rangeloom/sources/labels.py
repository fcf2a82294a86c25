"""Label sets: small tables of text about keys, from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.functions.encoding import from_hex


def as_labels(df: DataFrame, binary: list[str] | None = None) -> DataFrame:
    """All columns as text, but for key columns as bytes: those listed, else those with ``address`` in their name.
    Listed columns that do not exist are passed over; text that is not hex is an error."""
    keys = [c for c in df.columns if (c in binary if binary is not None else "address" in c.lower())]
    out = []
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        raw = from_hex(text)
        out.append((F.when(text.isNull() | raw.isNotNull(), raw).otherwise(F.raise_error(F.concat(F.lit(f"{c} is not hex: "), text))) if c in keys else text).alias(c))
    return df.select(out)


def read_labels(spark: SparkSession, path: str, binary: list[str] | None = None) -> DataFrame:
    """A label set from a CSV file with a header."""
    return as_labels(spark.read.option("header", True).csv(path), binary)


class LabelRegistry:
    """Named label sets of a session, as temporary views."""

    PREFIX = "labels__"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def add(self, name: str, labels: DataFrame) -> None:
        """Adds a set, or replaces one of that name."""
        labels.createOrReplaceTempView(self.PREFIX + name)

    def get(self, name: str) -> DataFrame:
        if name not in self.names():
            raise KeyError(f"no label set {name}")
        return self.spark.table(self.PREFIX + name)

    def names(self) -> list[str]:
        return sorted(t.name.removeprefix(self.PREFIX) for t in self.spark.catalog.listTables() if t.isTemporary and t.name.startswith(self.PREFIX))

    def remove(self, name: str) -> bool:
        return self.spark.catalog.dropTempView(self.PREFIX + name)

    def clear(self) -> None:
        for name in self.names():
            self.remove(name)
