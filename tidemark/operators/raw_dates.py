"""Distinct business dates of a data table, read through its business column only.

Of a table given by its name not even that: where the business column is one it is partitioned by, the
catalog lists its dates, and the newest date of an integer or date column is in the files' statistics.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import labels

# Fixed value: how the catalog writes a partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def is_partitioned_by(spark: SparkSession, table: str, column: str) -> bool:
    return any(c.isPartition and c.name == column for c in spark.catalog.listColumns(table))


def listed_dates(spark: SparkSession, table: str, column: str) -> DataFrame:
    """Distinct values of a column the table is partitioned by, as the catalog lists them: no file is opened.

    A partition is taken to hold rows, as those that loads leave do. The driver sees one short text a partition,
    as it does whenever such a table is read.
    """
    written = F.regexp_extract("partition", f"(?:^|/){re.escape(column)}=([^/]*)", 1)
    value = F.url_decode(F.replace(written, F.lit("+"), F.lit("%2B")))  # escaped like an address, but for the plus
    kind = spark.table(table).schema[column].dataType
    return (
        spark.sql(f"SHOW PARTITIONS {table}")
        .select(F.when(written != _NO_VALUE, value).cast(kind).alias(column)).distinct()
    )


def business_dates(spark: SparkSession, table: str, column: str) -> DataFrame:
    """The column's values for ``dates_equal`` and the others: listed where the table is partitioned by it."""
    if is_partitioned_by(spark, table, column):
        return listed_dates(spark, table, column)
    return spark.table(table).select(column)


def newest_from_statistics(spark: SparkSession, table: str, column: str) -> DataFrame | None:
    """One row with the column's greatest value, from the statistics in the files' footers; no data is read.

    For integer and date columns of Parquet tables that are not partitioned; None for others. Settings of the newer
    reader, which can answer from statistics, are made in a session of its own.
    """
    kind = spark.table(table).schema[column].dataType
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(table))
    if partitioned or (described.get("Provider") or "").lower() != "parquet" or not isinstance(kind, (T.IntegralType, T.DateType)):
        return None
    reader = spark.newSession()
    reader.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return reader.read.schema(spark.table(table).schema).parquet(described["Location"]).agg(F.max(column).alias(column))


def dates_equal(table: DataFrame, column: str, label: Column | str) -> DataFrame:
    return table.filter(F.col(column) == label).select(column).distinct()


def dates_between(table: DataFrame, column: str, low: Column | str, high: Column | str) -> DataFrame:
    return table.filter(F.col(column).between(low, high)).select(column).distinct()


def dates_in(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Dates that occur in ``wanted`` (column ``label``): a semi join, not an IN list."""
    dates = table.select(column).distinct()
    return dates.join(wanted, dates[column] == wanted["label"], "left_semi")


def dates_all(table: DataFrame, column: str) -> DataFrame:
    return table.select(column).distinct()


def dates_from(table: DataFrame, column: str, label: Column | str) -> DataFrame:
    return table.filter(F.col(column) >= label).select(column).distinct()


Span = tuple[str | None, str | None]


def _bound(kind: T.DataType, label: str) -> Column | None:
    """A label as a value of the column's type, where labels of that form sort as its values do."""
    if isinstance(kind, T.StringType):
        return F.lit(label)
    if isinstance(kind, T.IntegralType) and label.isdigit():
        return F.lit(int(label))
    if isinstance(kind, T.DateType) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", label):
        return F.lit(label).cast("date")
    return None


def _within(df: DataFrame, column: str, spans: Sequence[Span]) -> Column:
    """Rows in any of the label ranges, in the column's own type, so that the scan can skip.

    A range that cannot be told in that type keeps all rows.
    """
    kind, arms = df.schema[column].dataType, []
    for low, high in spans:
        bounds = [None if label is None else _bound(kind, label) for label in (low, high)]
        arm = F.lit(True)
        if bounds[0] is not None:
            arm = arm & (F.col(column) >= bounds[0])
        if bounds[1] is not None:
            arm = arm & (F.col(column) <= bounds[1])
        arms.append(arm)
    return reduce(Column.__or__, arms, F.lit(False))


def observed_dates(
    tables: Mapping[tuple[str, str, str], DataFrame],
    spans: Mapping[tuple[str, str, str], Sequence[Span]] | None = None,
) -> DataFrame:
    """Business dates of many tables, keyed by (schema, table, column).

    Each table contributes one partial distinct over a single column; with ``spans``, ranges
    of labels per table, only over the rows in them.
    """
    def rows(key: tuple[str, str, str]) -> DataFrame:
        df, column = tables[key], key[2]
        return df.filter(_within(df, column, spans[key])) if spans else df

    return reduce(
        DataFrame.unionByName,
        [
            dates_all(rows(key).select(F.col(key[2]).cast("string").alias("label")), "label")
            .filter(F.col("label").isNotNull())
            .select(F.lit(key[0]).alias("schema_nm"), F.lit(key[1]).alias("table_nm"),
                    F.lit(key[2]).alias("data_column"), "label")
            for key in tables
        ],
    )


def newest_label(spark: SparkSession, table: str, column: str, patterns: Sequence[str]) -> str | None:
    """The newest date as a label, if statistics tell it and it is a date in each of the label patterns."""
    found = newest_from_statistics(spark, table, column)
    try:
        value = found.first()[0] if found is not None else None
    except Exception:  # a file without the statistics, as one whose values are all null: the data has to be read
        value = None
    if value is None:
        return None
    read = spark.createDataFrame([(str(value), p) for p in patterns], "label string, label_pattern string")
    unread = read.filter(F.expr(labels.read("label", "label_pattern")).isNull())
    return str(value) if unread.isEmpty() else None


def _month_no(label: str) -> str:
    ts = labels.read(label, "label_pattern")
    return f"year({ts}) * 12 + month({ts})"


def _with_kind(distinct_labels: DataFrame) -> DataFrame:
    """Whether a label's pattern can be read as a range; worked out on distinct labels.

    What is said of the pattern passes through a one-row ``inline``, which keeps Spark from
    repeating those long expressions wherever they are used.
    """
    about = F.array(F.struct(
        F.expr(labels.spark_pattern("pattern")).alias("label_pattern"),
        F.expr(labels.sorts_chronologically("pattern")).alias("sorts"),
    ))
    month = F.array(F.struct(F.expr(_month_no("label")).alias("month_no")))
    return (
        distinct_labels.select("*", F.inline(about))
        .select("*", F.inline(month))
        .withColumn("ranged", F.col("sorts") & F.col("month_no").isNotNull())
    )


def range_or_set_scan(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Labels and row counts of the table that each dependency asks for.

    ``table`` holds the label column and its ``pattern``; ``wanted`` holds ``dep_id``,
    ``pattern`` and the dependency's ``label`` set. When labels of a pattern sort by time
    and name a full date, the dependency reads the whole range from its first to its last
    label; otherwise it reads exactly its labels. The table is read once and shrinks to
    distinct labels before the join, which matches on equal keys: the month of a range, or
    the label itself.
    """
    present = _with_kind(
        table.groupBy("pattern", F.col(column).alias("label")).agg(F.count("*").alias("row_cnt"))
    ).withColumn("bucket", F.expr("CASE WHEN ranged THEN cast(month_no AS string) ELSE label END"))
    spans = (
        _with_kind(wanted.select("dep_id", "pattern", "label").distinct())
        .groupBy("dep_id", "pattern", F.expr("CASE WHEN NOT ranged THEN label END").alias("one_label"))
        .agg(F.min("label").alias("low"), F.max("label").alias("high"),
             F.min("month_no").alias("first_month"), F.max("month_no").alias("last_month"))
        .withColumn("bucket", F.explode(F.expr("""CASE
            WHEN one_label IS NOT NULL THEN array(one_label)
            ELSE cast(sequence(first_month, last_month) AS array<string>) END""")))
    )
    return (
        present.join(spans, ["pattern", "bucket"])
        .filter(F.col("label").between(F.col("low"), F.col("high")))
        .select("dep_id", "pattern", "label", "row_cnt")
    )
