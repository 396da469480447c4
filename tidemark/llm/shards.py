"""Shuffled shards of equal row counts by a two-pass external shuffle.

First pass: a seeded hash scatters the records uniformly into buckets sized for a task's memory.
Second pass: each bucket is shuffled (Fisher-Yates, seeded by the bucket) and written in that order.
The buckets one after another are one random order of all records; shard s is its s-th equal range,
so counts differ by one at most. ``manifest`` lists which rows of which bucket make up a shard.

The hash covers the id and a seeded draw for each row, so that an id that repeats in very many
rows is scattered as well. Which row gets which slot is fixed once the buckets are written: counts
and slots are derived from the written files only.

Defined cases: a null text counts no bytes and has the checksum of the empty string; null ids and
repeated rows are records like any other; all columns of the input are kept in ``record``, those that repeat
another's name, but for case, under names of their own (``common.apart``); an empty table gives no rows and empty shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import apart
from tidemark.session import fresh_path

SHARDS = 8
SEED = 42
BUCKET_BYTES = 64 << 20
#: Buckets for each shuffle partition, so that partitions hold about the same number.
SPREAD = 4
#: Up to so many buckets (16 TB of them) their list, a row of three numbers each, is sent to every task; beyond, it is joined.
LISTED = 1 << 18


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def shuffle_to_buckets(
    docs: DataFrame, path: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, int]:
    """Writes ``docs`` to ``path`` in shuffled buckets; (bucket, position, record) as read back, and how many buckets."""
    spark, docs = docs.sparkSession, apart(docs, key, text)
    n_bytes = docs.agg(F.sum(F.length(_text(text)) + 64).alias("n")).first()["n"] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(SPREAD * partitions, -(-n_bytes // bucket_bytes))
    scattered = docs.select(
        F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.rand(seed)), F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(0).cast("long").alias("position"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
    )

    def fisher_yates(bucket: pa.Table) -> pa.Table:
        number = bucket.column("bucket")[0].as_py()
        order = np.arange(bucket.num_rows)
        draws = np.random.default_rng([seed, number])
        for i, j in enumerate(draws.integers(0, np.arange(len(order), 0, -1) if len(order) else 1)):
            order[i], order[i + j] = order[i + j], order[i]
        return bucket.take(pa.array(order)).set_column(1, "position", pa.array(np.arange(len(order))))

    scattered.groupBy("bucket").applyInArrow(fisher_yates, scattered.schema).write.parquet(path)
    return spark.read.schema(scattered.schema).parquet(path), buckets


def manifest(written: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(bucket, start, total): where each bucket begins in the whole order. One row for each bucket."""
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    order = Window.orderBy("bucket")
    return counts.select(
        "bucket",
        (F.sum("n").over(order) - F.col("n")).alias("start"),
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )


def with_slots(written: DataFrame, buckets: int, shards: int = SHARDS) -> DataFrame:
    """Adds (shard, slot) to the rows of so many ``buckets``: the first ``total % shards`` shards hold one record more than the others."""
    small = F.expr(f"total div {shards}")
    extra = F.expr(f"total % {shards}")
    at = F.col("start") + F.col("position")
    cut = extra * (small + 1)
    early = at < cut
    late = F.nullif(small, F.lit(0))
    shard = F.when(early, F.floor(at / (small + 1))).otherwise(extra + F.floor((at - cut) / late))
    slot = F.when(early, at % (small + 1)).otherwise((at - cut) % late)
    listed = manifest(written, shards)
    # the records are not shuffled again for a list that fits a task
    return written.join(F.broadcast(listed) if buckets <= LISTED else listed, "bucket").select(
        "bucket", "position", "record", shard.cast("int").alias("shard"), slot.cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, path: str | None = None) -> DataFrame:
    """Shuffles ``docs`` into shards at ``path`` (by default in the shared folder); one row for each record."""
    path = path or fresh_path(docs.sparkSession, "shards")
    return with_slots(*shuffle_to_buckets(docs, path, seed), shards)


def digest(sharded: DataFrame) -> DataFrame:
    """What a record is and where it went, without its text."""
    text = _text("record.text")
    return sharded.select(
        F.col("record.doc_id").cast("long").alias("doc_id"),
        (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
