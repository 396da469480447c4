"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
# Paths handed out, by application, in order.
_written: dict[str, list[str]] = defaultdict(list)


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Control dates carry no zone; Spark formats and parses them in the session zone.

    Any zone with daylight saving would move labels around its gaps, so the session
    must run in UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one in the warehouse.

    On a cluster a warehouse on the driver's own disk is refused: executors would write to theirs, and lose
    it with their machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    warehouse = spark.conf.get(WAREHOUSE_DIR).rstrip("/")
    remote = "://" in warehouse and not warehouse.startswith("file:")
    if not remote and not spark.sparkContext.master.startswith("local") and _file_system(spark, warehouse)[0].getScheme() == "file":
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share: {warehouse} is a machine's own")
    return f"{warehouse}/_tidemark"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has written to.

    ``scratch`` deletes what is written there, unless it has become a table of the catalog.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written[spark.sparkContext.applicationId].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results that several branches of a plan need: their source is read once, a lost
    executor cannot take them along, and the written size tells Spark whether a
    broadcast is safe.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``materialize``, with the number of rows, which the write itself counts."""
    rows = Observation()
    written = materialize(df.observe(rows, F.count(F.lit(1)).alias("n")), name)
    return written, rows.get["n"]


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it lies; nothing happens if it is gone."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly in a folder; of one that is not there, none."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(place) if entry.isFile()]
    return [name for name in names if not name.startswith(("_", "."))]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; nothing happens if that was done before."""
    system, place = _file_system(spark, source)
    if system.exists(place) and not system.rename(place, _file_system(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def owns(spark: SparkSession, path: str) -> bool:
    """Is ``path`` a folder of ours, below the shared folder?"""
    system, place = _file_system(spark, path)
    base = system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark)))
    return system.makeQualified(place).toString().startswith(base.toString().rstrip("/") + "/")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, the intermediate tables written inside.

    Results computed from them must have been used or written by then. Folders of tables
    that are in the catalog of this session's database stay.
    """
    paths = _written[spark.sparkContext.applicationId]
    before = len(paths)
    try:
        yield
    finally:
        held = _table_folders(spark)
        for path in paths[before:]:
            if path.rsplit("/", 1)[-1] not in held:
                delete(spark, path)
        del paths[before:]


def _table_folders(spark: SparkSession) -> set[str]:
    """Last parts of the folders of the current database's tables; fresh paths are unique by them."""
    found = set()
    for table in spark.catalog.listTables():
        if not table.isTemporary:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED `{table.name}`").filter("col_name = 'Location'").first()
            if described:
                found.add(described["data_type"].rstrip("/").rsplit("/", 1)[-1])
    return found


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread few rows that each cost much over all shuffle partitions.

    A given partition count, unlike a plain shuffle, is not merged by adaptive execution,
    which would judge the rows by their size.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)
