"""JDBC sources: a remote query as a DataFrame, with one fixed type mapping.

The connection comes from the caller (from Spark conf, not from code). Give
``partition_column`` with its bounds to read with many tasks; without it JDBC reads with
one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# JDBC type name -> Spark type. Decimals keep their precision; any other
# type is read as text.
JDBC_TYPES = {
    "BOOLEAN": "boolean", "BIT": "boolean",
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int",
    "BIGINT": "bigint",
    "FLOAT": "double", "REAL": "double", "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp", "TIMESTAMP_WITH_TIMEZONE": "timestamp",
    "TIME": "string", "TIME_WITH_TIMEZONE": "string",
    "BINARY": "binary", "VARBINARY": "binary", "LONGVARBINARY": "binary",
}
MAX_PRECISION = 38


def spark_type(jdbc_type: str, precision: int = 0, scale: int = 0) -> str:
    name = jdbc_type.upper()
    if name in ("DECIMAL", "NUMERIC"):
        digits = min(max(precision, 1), MAX_PRECISION)
        return f"decimal({digits},{min(max(scale, 0), MAX_PRECISION)})"
    return JDBC_TYPES.get(name, "string")


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns cast to the mapped types; columns without a listed type stay as read."""
    return df.select(*[
        F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def options(
    url: str, query: str, properties: Mapping[str, str] | None = None,
    partition_column: str | None = None, lower: int | str | None = None,
    upper: int | str | None = None, partitions: int | None = None, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. A partitioned read needs the query as a derived table."""
    chosen = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        return {**chosen, "query": query}
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return {
        **chosen, "dbtable": f"({query}) remote_query", "partitionColumn": partition_column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
    }


def query_scan(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**options(url, query, **kwargs)).load()


# Types Spark gives a result's columns from its metadata -> JDBC type name, where the
# fixed mapping differs from Spark's own.
_READ_AS = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "float": "REAL", "timestamp_ntz": "TIMESTAMP",
}


def result_types(df: DataFrame) -> dict[str, str]:
    """The fixed type of each column, from the types the result's own metadata gave it."""
    return {
        f.name: spark_type(_READ_AS[f.dataType.simpleString()])
        for f in df.schema.fields if f.dataType.simpleString() in _READ_AS
    }


def typed_query_scan(
    spark: SparkSession, url: str, query: str, types: Mapping[str, str] | None = None, **kwargs
) -> DataFrame:
    """A remote query in the fixed types: the given ones, else those of its own metadata."""
    rows = query_scan(spark, url, query, **kwargs)
    return typed(rows, result_types(rows) if types is None else types)
