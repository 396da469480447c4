"""What several text operators share: words, tables, row numbers and vocabulary files."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_path

#: The white space between words: space and the five ASCII controls from tab to carriage return.
WHITE = r"[\x20\x09-\x0D]"
#: Characters whose class, case or composition libraries may see differently by their Unicode version:
#: all beyond the Latin letters, and controls. Texts that hold one are left to the vocabulary's own library.
UNUSUAL = re.compile("[^\t-\r\x20-\x84\x86-\u02ff]")


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where they share the driver's folders but not its path."""
    home = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return on_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, taken by place: others may repeat a name or differ from it by case."""
    places = {name: df.columns.index(name) for name in names}
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.select(*[F.col(f"c{i}").alias(name) for name, i in places.items()])


def apart(df: DataFrame, *needed: str) -> DataFrame:
    """``df`` with names that differ by more than case: the ``needed`` columns keep theirs (the first of each name).

    Of the others, one whose name is taken gets its place behind it: ``text_5``.
    """
    places = {df.columns.index(name): name for name in needed}
    taken, names = {name.lower() for name in needed}, []
    for i, name in enumerate(df.columns):
        if i not in places:
            while name.lower() in taken:
                name = f"{name}_{i}"
            taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)


def words(text: Column) -> Column:
    """The words of ``text`` in order; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WHITE}+", -1), "")


def vocabulary_path(vocabulary: str) -> str:
    """``vocabulary`` is a file, or the name of one of the installed public vocabularies."""
    if os.path.exists(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def values(column: pa.Array, at_once: int = 256) -> Iterator:
    """The column's values, a few at a time as Python objects: a batch of texts is not held twice."""
    for start in range(0, len(column), at_once):
        yield from column.slice(start, at_once).to_pylist()


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str):
    """A ``tokenizers`` vocabulary, loaded once in each worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(vocabulary))


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder with a gapless ``number`` from 0, and how many rows it has.

    A row's place (task, row in the task) is written with it, so a task that runs again cannot
    renumber rows that others have read. The driver sees, and broadcasts, one count for each task
    that wrote: 16 bytes a task, whatever its rows.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    placed = df.withColumn("place", F.monotonically_increasing_id())
    placed.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    counts = (
        placed.groupBy(F.shiftright("place", 33).alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()
    )
    starts, total = [], 0
    for row in counts:
        starts.append((row["task"], total))
        total += row["n"]
    starts = spark.createDataFrame(starts, "place_task long, place_start long")
    in_task = F.col("place") - F.shiftleft(F.shiftright("place", 33), 33)
    out = (
        placed.withColumn("place_task", F.shiftright("place", 33)).join(F.broadcast(starts), "place_task")
        .withColumn("number", F.col("place_start") + in_task).drop("place_task", "place_start", "place")
    )
    return out, total
