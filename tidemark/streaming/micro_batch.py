"""Loading a stream into its target, each micro-batch once.

A batch that was recorded is skipped when it is replayed. Should the process die between
loading and recording, the replay leaves the same result: an upsert is a version of its table, named by the batch,
that is applied once; an update or overwrite repeats itself; and appended rows go to a partition of their
own batch, which the replay overwrites. Partitions of recorded batches, which no replay reaches, are merged
into ranges, so that a table has few of them however long its stream runs.

With an ordering column the newest version of a row wins, whenever it arrives: files and
topics do not promise that a batch holds newer rows than the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import MapType

from tidemark.operators import loads, raw_dates
from tidemark.session import delete, exists, fresh_path

BATCH_COLUMN = "batch_id"
#: So many neighbouring partitions of a size are merged into one.
FANOUT = 16


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """Topic values parsed as JSON; needs the Kafka package on the cluster."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).load()
    )
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(parsed.alias("row")).select("row.*")


class BatchLog:
    """How far a stream has loaded: batches come in order, so the highest id says it all.

    Two places in the shared folder are written in turn; a process that dies while writing
    one leaves the other.
    """

    PLACES = 2

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def version(self, batch_id: int) -> str:
        """The name of a batch of this stream."""
        return f"{self._path}#{batch_id}"

    def _highest(self, place: int) -> int:
        logged = self._spark.read.schema(f"{BATCH_COLUMN} bigint").parquet(f"{self._path}/{place}")
        highest = logged.agg(F.max(BATCH_COLUMN)).first()[0]
        return -1 if highest is None else highest

    def highest(self) -> int:
        found = [-1]
        for place in range(self.PLACES):
            try:
                found.append(self._highest(place))
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":  # nothing recorded there yet
                    raise
        return max(found)

    def has(self, batch_id: int) -> bool:
        return batch_id <= self.highest()

    def record(self, batch_id: int) -> None:
        row = self._spark.range(1).select(F.lit(batch_id).cast("bigint").alias(BATCH_COLUMN))
        row.write.mode("overwrite").parquet(f"{self._path}/{batch_id % self.PLACES}")


def newest_versions(batch: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the one with the highest ``order_by``; a tie goes to the same row in any order."""
    hashable = [f.name for f in batch.schema.fields if not isinstance(f.dataType, MapType)]
    order = F.struct(F.col(order_by), F.xxhash64(*hashable))
    return batch.groupBy(*keys).agg(
        F.max_by(F.struct(*batch.columns), order).alias("row")
    ).select("row.*")


# --- append partitions ------------------------------------------------------------------


def merges(batch_id: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """Ranges of batches to merge once ``batch_id`` is recorded: the largest that ends with it, if any.

    Like the carry of a counter to the base ``fanout``: after n batches at most fanout - 1 partitions of each of
    log n sizes are left, and a row is rewritten log n times.
    """
    size = 1
    while (batch_id + 1) % (size * fanout) == 0:
        size *= fanout
    return [(batch_id + 1 - size, batch_id)] if size > 1 else []


def compact(spark: SparkSession, table: str, first: int, last: int) -> None:
    """Merge the partitions of batches ``first`` to ``last`` into the last one's.

    The merged rows are written aside, and the table notes them before any partition changes; should that be
    interrupted, the next batch ends it. A reader in between may see rows of the range twice.
    """
    held = sorted(r[0] for r in raw_dates.listed_dates(spark, table, BATCH_COLUMN).filter(F.col(BATCH_COLUMN).between(first, last)).collect())
    if len(held) < 2:
        return
    path = fresh_path(spark, f"{table}-merged")
    rows = spark.table(table).filter(F.col(BATCH_COLUMN).between(first, last))
    rows.withColumn(BATCH_COLUMN, F.lit(last).cast("bigint")).write.parquet(path)
    loads.prepared(spark, table, f"{first}-{last}", {"merged": path, "first": first, "last": last})
    _finish(spark, table)


def _finish(spark: SparkSession, table: str) -> None:
    """End a merge that lies ready: write the range's last partition, then drop the others."""
    waiting = loads.pending(spark, table)
    if waiting is None or "merged" not in waiting:
        return
    if exists(spark, waiting["merged"]):
        loads.overwrite_partitions(spark.read.schema(spark.table(table).schema).parquet(waiting["merged"]), table)
        for batch in range(waiting["first"], waiting["last"]):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH_COLUMN} = {batch})")
            delete(spark, f"{loads.location(spark, table)}/{BATCH_COLUMN}={batch}")
        spark.catalog.refreshTable(table)
        delete(spark, waiting["merged"])
    loads.applied(spark, table, waiting["version"])


def load_batch(
    batch: DataFrame, batch_id: int, log: BatchLog, table: str, mode: str,
    keys: Sequence[str] = (), order_by: str | None = None, fanout: int = FANOUT, **options,
) -> bool:
    """Load one batch unless it was loaded before; says whether it did.

    With ``order_by`` the newest row of each key wins: within the batch, and against the
    row the target holds, which only a higher value replaces (an equal one leaves it).
    Appended rows carry the batch they came with, or the last of the range it was merged into.
    """
    spark, appends = batch.sparkSession, mode.lower() == "append"
    if appends:
        _finish(spark, table)
    if log.has(batch_id):
        return False
    if keys and order_by:
        batch = newest_versions(batch, keys, order_by)
        newer = f"src.`{order_by}` > trg.`{order_by}` OR (trg.`{order_by}` IS NULL AND src.`{order_by}` IS NOT NULL)"
        options["update_when"] = newer
    if appends:
        loads.overwrite_partitions(
            batch.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint")), table
        )
    else:
        loads.load(batch, table, mode, keys=keys, version=log.version(batch_id), **options)
    log.record(batch_id)
    if appends:
        for first, last in merges(batch_id, fanout):
            compact(spark, table, first, last)
    return True


def start(
    stream: DataFrame, table: str, mode: str, checkpoint: str, available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Run the stream into the table; progress and batch log live under ``checkpoint``."""
    log = BatchLog(stream.sparkSession, f"{checkpoint}/batches")

    def load_one(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, log, table, mode, **options)

    writer = stream.writeStream.option("checkpointLocation", f"{checkpoint}/progress").foreachBatch(
        load_one
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
