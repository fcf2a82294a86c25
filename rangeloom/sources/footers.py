"""Counts and bounds of Parquet tables from their footers: no column is read.

Spark's second Parquet reader answers count, min and max from footers if it may (aggregate pushdown). It is asked in a session of its own, so
the caller's settings stay as they are. That holds for tables read from files as they are; of filtered or joined rows only a scan knows the bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types whose bounds in footers are exact and ordered as Spark orders them (texts may be cut there, and floats are not in order with NaN).
ORDERED = {"tinyint", "smallint", "int", "bigint", "date"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same context that lets footers answer."""
    own = spark.newSession()
    for k, v in (("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text"), ("spark.sql.parquet.aggregatePushdown", "true"), ("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))):
        own.conf.set(k, v)
    return own


def plain_paths(df: DataFrame) -> list[str] | None:
    """The paths of a table that ``df`` is as read, but for a choice of columns; None for anything else."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "SubqueryAlias"):
        if node.getClass().getSimpleName() == "Project":
            kinds = {node.projectList().apply(i).getClass().getSimpleName() for i in range(node.projectList().size())}
            if kinds != {"AttributeReference"}:
                return None
        node = node.children().apply(0)
    if node.getClass().getSimpleName() != "LogicalRelation" or node.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    relation = node.relation()
    if relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat":
        return None
    roots = relation.location().rootPaths()
    return [roots.apply(i).toString() for i in range(roots.size())]


def from_footers(df: DataFrame, *aggregates: Column, columns: list[str]) -> DataFrame | None:
    """The aggregates (count of rows, min and max of ``columns``) of a table as read, from its footers; None if they cannot tell."""
    paths = plain_paths(df)
    if paths is None or any(df.schema[c].dataType.simpleString() not in ORDERED for c in columns):
        return None
    return footer_session(df.sparkSession).read.parquet(*paths).agg(*aggregates)


def file_sizes(df: DataFrame) -> tuple[int, int]:
    """Files of a table and their bytes, from the listing that Spark made when it was read."""
    node = df._jdf.queryExecution().analyzed().collectLeaves().apply(0)
    location = node.relation().location()
    return len(df.inputFiles()), int(location.sizeInBytes())


def bounds(df: DataFrame, column: str) -> tuple:
    """(least, greatest, rows) of a column: from footers where they can tell, else by a scan (files of nulls only have no bounds there)."""
    wanted = (F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n"))
    found = from_footers(df, *wanted, columns=[column])
    try:
        if found is not None:
            return tuple(found.first())
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
    return tuple(df.agg(*wanted).first())
