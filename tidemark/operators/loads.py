"""Loading a staged DataFrame into its target table.

Targets are catalog tables and keep their format. Formats with a MERGE of their own are
written through it and through their own API; of the others, file formats alone are
taken, anything else is refused before a write. File tables have no MERGE, so upsert
and update rewrite: a whole table into a new version its name is then pointed at, a
partitioned table only in the partitions that change. The version before is deleted,
unless the load is told to ``keep_old``, for readers that still hold it.

A table bucketed by keys is rewritten only in the buckets that staged rows fall into, and joins staged rows of any
size without being moved; files of other buckets stay as they are.

The target is never shuffled for a small staging table: updates arrive by a left join and
inserts are found among the staged keys, and Spark broadcasts the staged side whenever it
is below the broadcast threshold. Larger staging sort-merges, with skewed keys split.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete, exists, file_names, fresh_path, move, owns

# Fixed value: the load time column keeps its old value on update.
NEVER_UPDATED = ("load_ts",)
LOAD_MODES = ("full_load", "overwrite", "append", "upsert", "update")


# Table properties: the last version a rewrite was given, and one that is prepared but perhaps not applied.
VERSION, PENDING = "tidemark.version", "tidemark.pending"


# Table formats with a MERGE of their own, and those rewritten as files.
MERGING_FORMATS = ("delta", "iceberg")
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv")


class DuplicateSourceError(ValueError):
    """Several staged rows would update one target row."""


# --- the target ---------------------------------------------------------------------


def _described(spark: SparkSession, table: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == what)
    return rows.first()["data_type"]


def location(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Location")


def _format(spark: SparkSession, table: str) -> str:
    """The table's format; refuses those that cannot be loaded."""
    found = _described(spark, table, "Provider").lower()
    if found not in MERGING_FORMATS + FILE_FORMATS:
        raise ValueError(f"{table}: cannot load tables of format {found}")
    return found


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _buckets(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """How many buckets the table has, by which columns; None without."""
    rows = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in rows:
        return None
    return int(rows["Num Buckets"]), re.findall("`((?:[^`]|``)+)`", rows["Bucket Columns"])


def _require(columns: Sequence[str], available: Sequence[str], where: str) -> None:
    lacking = [c for c in columns if c not in available]
    if lacking:
        raise ValueError(f"{where} has no column {', '.join(lacking)}")


def _as_table(df: DataFrame, table: str) -> DataFrame:
    """Columns by name, in the table's order and types."""
    fields = df.sparkSession.table(table).schema.fields
    _require([f.name for f in fields], df.columns, "the staged table")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _retyped(df: DataFrame, table: str) -> DataFrame:
    """The columns it shares with the table in the table's types, the others as they are."""
    types = {f.name: f.dataType for f in df.sparkSession.table(table).schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


# --- writing ----------------------------------------------------------------------------


def create_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), table_format: str = "parquet",
    buckets: int = 0, bucket_by: Sequence[str] = (),
) -> None:
    """Create the table from ``df`` with its data in the shared folder, in ``buckets`` by the columns ``bucket_by`` if given."""
    path = fresh_path(df.sparkSession, table.replace(".", "-"))
    rows = df.repartition(buckets, *bucket_by) if buckets else _by_partition(df, partition_by)
    writer = rows.write.format(table_format).option("path", path).partitionBy(*partition_by)
    (writer.bucketBy(buckets, *bucket_by) if buckets else writer).saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table and its folder, if the folder is ours."""
    path = location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    _retire(spark, path)


def _retire(spark: SparkSession, path: str) -> None:
    if owns(spark, path):
        delete(spark, path)


def _by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together, so that not every task writes to every one.

    Rebalancing, unlike repartitioning, lets Spark cut a large partition into many tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _point_at(spark: SparkSession, table: str, path: str, keep_old: bool) -> None:
    before = location(spark, table)
    if before.rstrip("/").rsplit("/", 1)[-1] == path.rstrip("/").rsplit("/", 1)[-1]:
        return  # it points there already
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    if not keep_old:
        _retire(spark, before)


# --- versions ----------------------------------------------------------------------------


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_properties(spark: SparkSession, table: str, **values: str) -> None:
    names = {"version": VERSION, "pending": PENDING}
    given = ", ".join(f"'{names[k]}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({given})")


def prepared(spark: SparkSession, table: str, version: str, change: dict) -> None:
    """Commit a change whose result lies ready: from here on it happens, whoever applies it.

    The table's own property is the one thing that is written; what went before has touched nothing of
    the table, and what follows repeats itself.
    """
    _set_properties(spark, table, pending=json.dumps({"version": version, **change}))


def pending(spark: SparkSession, table: str) -> dict | None:
    found = _properties(spark, table).get(PENDING)
    return json.loads(found) if found else None


def applied(spark: SparkSession, table: str, version: str) -> None:
    _set_properties(spark, table, version=version, pending="")


def has_version(spark: SparkSession, table: str, version: str) -> bool:
    return _properties(spark, table).get(VERSION) == version


def full_load(
    staged: DataFrame, table: str, partition_by: Sequence[str] = (), keep_old: bool = False
) -> None:
    """Replace the table, its schema included; its format and partitioning stay.

    A table that is not there yet is partitioned by ``partition_by``.
    """
    spark = staged.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(staged, table, partition_by)
        return
    found, columns = _format(spark, table), _partition_columns(spark, table)
    _require(columns, staged.columns, "the staged table")
    if found in MERGING_FORMATS:
        writer = staged.writeTo(table).using(found)
        (writer.partitionedBy(*map(F.col, columns)) if columns else writer).createOrReplace()
        return
    before, path = location(spark, table), fresh_path(spark, table.replace(".", "-"))
    rows = _by_partition(staged, columns).write.format(found).option("path", path)
    rows, buckets = rows.partitionBy(*columns), _buckets(spark, table)
    (rows.bucketBy(buckets[0], *buckets[1]) if buckets else rows).mode("overwrite").saveAsTable(table)
    if not keep_old:
        _retire(spark, before)


def overwrite_partitions(staged: DataFrame, table: str) -> None:
    """Replace only the partitions that occur in the staged rows.

    Dynamic overwrite is given as an option of this one insert: as a setting of the session
    other loads would feel it. Spark writes in the table's format and tells the catalog of
    new partitions.
    """
    spark = staged.sparkSession
    found, columns = _format(spark, table), _partition_columns(spark, table)
    if not columns:
        raise ValueError(f"{table} is not partitioned")
    rows = _by_partition(_as_table(staged, table), columns)
    if found in MERGING_FORMATS:
        rows.writeTo(table).overwritePartitions()
        return
    view = f"staged_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(table)


def append(staged: DataFrame, table: str) -> None:
    spark = staged.sparkSession
    found = _format(spark, table)
    rows = _by_partition(_as_table(staged, table), _partition_columns(spark, table))
    if found in MERGING_FORMATS:
        rows.writeTo(table).append()
    else:
        rows.write.mode("append").insertInto(table)


def overwrite_feed_partitions(staged: DataFrame, table: str) -> None:
    """Staging into its parent table, partitioned by feed and control date."""
    if staged.sparkSession.catalog.tableExists(table):
        overwrite_partitions(staged, table)
    else:
        create_table(staged, table, ("feed_ind", "ictrl_dt"))


# --- matching ----------------------------------------------------------------------------


def _matches(keys: Sequence[str], condition: str | None) -> Column:
    """``trg`` and ``src`` agree on all keys (null never agrees) and the condition holds."""
    if not keys:
        raise ValueError("rows are matched by keys; none are given")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"trg.{key}") == F.col(f"src.{key}"))
    return on & F.expr(condition) if (condition or "").strip() else on


def duplicate_sources(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], condition: str | None = None
) -> DataFrame:
    """Target rows that several staged rows match: key values and ``matches``.

    Without a condition every staged row of a key matches, so counting staged rows per
    key is enough. With one, only keys staged more than once are joined and counted per
    target row; the merge itself would meet the same pairs.
    """
    repeated = (
        staged.groupBy(*keys).agg(F.count("*").alias("matches")).filter("matches > 1")
    )
    if not (condition or "").strip():
        on = _matches(keys, None)
        return repeated.alias("src").join(target.alias("trg"), on, "left_semi")
    again = staged.join(repeated.drop("matches"), list(keys), "left_semi")
    numbered = target.withColumn("_row", F.monotonically_increasing_id())
    return (
        numbered.alias("trg").join(again.alias("src"), _matches(keys, condition))
        .groupBy("trg._row", *[F.col(f"trg.{k}").alias(k) for k in keys])
        .agg(F.count("*").alias("matches")).filter("matches > 1").drop("_row")
    )


def check_single_source(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], condition: str | None = None
) -> None:
    """Refuses staged rows that would update one target row together.

    The target is only read when some key is staged more than once.
    """
    if staged.groupBy(*keys).count().filter("count > 1").isEmpty():
        return
    example = duplicate_sources(target, staged, keys, condition).head(1)
    if example:
        raise DuplicateSourceError(f"several staged rows match one target row: {example[0]}")


def _with_updates(
    target: DataFrame, staged: DataFrame, on: Column, updated: Sequence[str],
    when: str | None = None,
) -> DataFrame:
    """All target rows, the updated columns taken from the matching staged row."""
    joined = target.alias("trg").join(
        staged.withColumn("_staged", F.lit(True)).alias("src"), on, "left"
    )
    takes = F.col("src._staged").isNotNull()
    if (when or "").strip():
        takes = takes & F.coalesce(F.expr(when), F.lit(False))
    return joined.select(*[
        F.when(takes, F.col(f"src.{c}")).otherwise(F.col(f"trg.{c}")).alias(c)
        if c in updated else F.col(f"trg.{c}")
        for c in target.columns
    ])


def merged(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], condition: str | None = None,
    update_columns: Sequence[str] | None = None, update_when: str | None = None,
) -> DataFrame:
    """The target after an upsert, as one DataFrame."""
    kept, inserts = merged_parts(target, staged, keys, condition, update_columns, update_when)
    return kept.unionByName(inserts)


def merged_parts(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], condition: str | None = None,
    update_columns: Sequence[str] | None = None, update_when: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The target's rows after an upsert and the rows it inserts.

    A staged row matches on equal keys and the condition together, so a key match that
    fails the condition inserts a second row, and a null key always inserts. Matched rows
    take the chosen columns (default all) except the load time; no column, no update.
    ``update_when`` is asked of matched rows only: one that fails it stays as it is.
    """
    chosen = staged.columns if update_columns is None else update_columns
    updated = [c for c in chosen if c not in NEVER_UPDATED]
    on = _matches(keys, condition)
    kept = _with_updates(target, staged, on, updated, update_when) if updated else target
    # The target meets only staged keys; what is left of it is no larger than the match.
    reached = target.alias("trg").join(
        staged.select(*keys).alias("src"), _matches(keys, None), "left_semi"
    )
    if not (condition or "").strip():
        reached = reached.select(*keys).distinct()
    inserts = staged.alias("src").join(reached.alias("trg"), on, "left_anti")
    return kept, inserts.select(*target.columns)


def updated(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], update_columns: Sequence[str],
    condition: str | None = None,
) -> DataFrame:
    """The target after an update: listed columns of matched rows where the condition holds."""
    return _with_updates(target, staged, _matches(keys, None), update_columns, condition)


def merge_statement(
    table: str, source: str, keys: Sequence[str], columns: Sequence[str],
    condition: str | None, updates: Sequence[str], update_when: str | None = None,
    inserts: bool = True,
) -> str:
    """MERGE for tables whose format supports it, with the same matching as the rewrite."""
    on = " AND ".join([f"trg.`{k}` = src.`{k}`" for k in keys] + ([f"({condition})"] if condition else []))
    parts = [f"MERGE INTO {table} AS trg USING {source} AS src ON {on}"]
    if updates:
        sets = ", ".join(f"trg.`{c}` = src.`{c}`" for c in updates)
        parts.append(f"WHEN MATCHED{f' AND ({update_when})' if update_when else ''} THEN UPDATE SET {sets}")
    if inserts:
        names, values = (", ".join(f"{p}`{c}`" for c in columns) for p in ("", "src."))
        parts.append(f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
    return " ".join(parts)


def _merge(staged: DataFrame, table: str, **clauses) -> None:
    view = f"staged_{uuid.uuid4().hex}"
    staged.createOrReplaceTempView(view)
    try:
        staged.sparkSession.sql(merge_statement(table, view, columns=staged.columns, **clauses))
    finally:
        staged.sparkSession.catalog.dropTempView(view)


# --- rewriting -----------------------------------------------------------------------


def _rewrite(
    spark: SparkSession, table: str, staged: DataFrame, keys: Sequence[str],
    change: Callable[[DataFrame], Sequence[DataFrame]], adds_rows: bool, sets: Sequence[str], keep_old: bool,
    version: str | None = None,
) -> None:
    """Apply ``change`` to the table, or only to its partitions that change.

    ``change`` gives the result in parts, which are written one after another: in a union a task holds the sorts of
    all parts that are partitioned alike, and the others share the cores.
    The result is written to the shared folder first, because Spark cannot overwrite what it
    is reading, and then applied. With a ``version`` the table notes in between that it lies ready.
    """
    path = fresh_path(spark, table.replace(".", "-"))
    buckets = _buckets(spark, table)
    if buckets and set(buckets[1]) <= set(keys) and not _partition_columns(spark, table) and not set(sets) & (set(buckets[1]) - set(keys)):
        _prepare_buckets(spark, table, path, staged, *buckets, change)
    else:
        _prepare(spark, table, path, staged, keys, change, adds_rows, sets)
    if version is not None:
        prepared(spark, table, version, {"path": path})
    _apply(spark, table, path, keep_old)
    if version is not None:
        applied(spark, table, version)


def _emptied(path: str) -> str:
    return f"{path}-emptied"


def _touched(path: str) -> str:
    return f"{path}-touched"


def _save(parts: Sequence[DataFrame], table: str, path: str, file_format: str) -> None:
    for n, part in enumerate(parts):
        _as_table(part, table).write.format(file_format).mode("append" if n else "errorifexists").save(path)


def _prepare(
    spark: SparkSession, table: str, path: str, staged: DataFrame, keys: Sequence[str],
    change: Callable[[DataFrame], Sequence[DataFrame]], adds_rows: bool, sets: Sequence[str],
) -> None:
    """The changed table, or its changed partitions and a list of those that end up empty, at ``path``.

    Touched are the partitions of matched rows and, for inserts, of staged rows. Rows leave a partition only when one
    of its columns is set.
    """
    target, found = spark.table(table), _format(spark, table)
    partitions = _partition_columns(spark, table)
    if not partitions:
        parts, buckets = change(target), _buckets(spark, table)
        if buckets:
            _write_bucketed(parts, table, path, *buckets)
        else:
            _save(parts, table, path, found)
        return
    matched = target.alias("trg").join(
        staged.select(*keys).alias("src"), _matches(keys, None), "left_semi"
    ).select(*partitions)
    touched = matched.unionByName(staged.select(*partitions)) if adds_rows else matched
    # Once, as each part needs them; a row a partition.
    touched.distinct().write.parquet(_touched(path))
    touched = spark.read.schema(touched.schema).parquet(_touched(path))
    same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in partitions]
    affected = target.alias("old").join(touched.alias("new"), same, "left_semi")
    _save(change(affected), table, path, "parquet")
    if set(sets) & set(partitions):
        rewritten = spark.read.schema(target.schema).parquet(path)
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
        files = target.select(*partitions, folder).distinct().alias("old")
        emptied = files.join(touched.alias("new"), same, "left_semi").join(rewritten.alias("new"), same, "left_anti")
        emptied.select("folder").write.parquet(_emptied(path))
    delete(spark, _touched(path))


def _replaced(path: str) -> str:
    return f"{path}-replaced"


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """The bucket Spark puts a row in."""
    return F.pmod(F.hash(*columns), F.lit(buckets))


def _bucket_in_name(name: str) -> int:
    """Spark ends the names of a bucketed table's files with the bucket."""
    return int(re.search(r"_(\d+)(?:\..*)?$", name)[1])


def _write_bucketed(parts: Sequence[DataFrame], table: str, path: str, buckets: int, columns: Sequence[str]) -> None:
    """Only tables of the catalog are written in buckets: one that is gone once its files are there."""
    spark, written = parts[0].sparkSession, f"bucketed_{uuid.uuid4().hex}"
    for n, part in enumerate(parts):
        writer = _as_table(part, table).write.format(_format(spark, table)).mode("append" if n else "errorifexists")
        writer.bucketBy(buckets, *columns).option("path", path).saveAsTable(written)
    spark.sql(f"DROP TABLE {written}")  # a table with a path of its own leaves its files


def _of_buckets(spark: SparkSession, table: str, names: Sequence[str]) -> DataFrame:
    """The table's rows in these files; still in buckets, so a join by them does not move the rows."""
    return spark.table(table).filter(F.col("_metadata.file_name").isin(list(names)))


def _prepare_buckets(
    spark: SparkSession, table: str, path: str, staged: DataFrame, buckets: int, columns: Sequence[str],
    change: Callable[[DataFrame], Sequence[DataFrame]],
) -> None:
    """New files at ``path`` for the buckets that staged rows fall into, and a list of the files they replace.

    A row that matches by the keys has the staged row's bucket, as the table is bucketed by some of them. The
    driver sees a number a touched bucket and the names of their files.
    """
    touched = {r[0] for r in staged.select(bucket_of(columns, buckets)).distinct().collect()}
    names = [n for n in file_names(spark, location(spark, table)) if _bucket_in_name(n) in touched]
    _write_bucketed(change(_of_buckets(spark, table, names)), table, path, buckets, columns)
    spark.createDataFrame([(n,) for n in names], "name string").write.parquet(_replaced(path))


def _apply_buckets(spark: SparkSession, table: str, path: str) -> None:
    """New files in, replaced ones out; a reader in between may see rows of a bucket twice."""
    folder = location(spark, table)
    for name in file_names(spark, path):
        move(spark, f"{path}/{name}", f"{folder}/{name}")
    for row in spark.read.schema("name string").parquet(_replaced(path)).collect():
        delete(spark, f"{folder}/{row['name']}")
    spark.catalog.refreshTable(table)
    delete(spark, path)
    delete(spark, _replaced(path))


def _apply(spark: SparkSession, table: str, path: str, keep_old: bool) -> None:
    """Bring the table to what was prepared at ``path``; again, if that was interrupted.

    Folders of partitions that ended up empty are deleted, and the catalog is brought in line with the folders once.
    """
    if exists(spark, _replaced(path)):
        _apply_buckets(spark, table, path)
        return
    if _buckets(spark, table) and not exists(spark, path) and not _partition_columns(spark, table):
        return  # the last step was done
    if not _partition_columns(spark, table):
        _point_at(spark, table, path, keep_old)
        return
    if not exists(spark, path):
        return  # the last step was done
    rewritten = spark.read.schema(spark.table(table).schema).parquet(path)
    if not rewritten.isEmpty():
        overwrite_partitions(rewritten, table)
    if exists(spark, _emptied(path)):
        folders = [row["folder"] for row in spark.read.schema("folder string").parquet(_emptied(path)).toLocalIterator()]
        for gone in folders:
            delete(spark, spark._jvm.java.net.URI(gone))
        if folders:
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
            spark.catalog.refreshTable(table)
        delete(spark, _emptied(path))
    delete(spark, path)


def _done_before(spark: SparkSession, table: str, version: str | None, keep_old: bool) -> bool:
    """Was this version applied already, or is it now, as it lay ready?"""
    if version is None:
        return False
    if has_version(spark, table, version):
        return True
    waiting = pending(spark, table)
    if waiting is None or waiting["version"] != version:
        return False
    _apply(spark, table, waiting["path"], keep_old)
    applied(spark, table, version)
    return True


def _checked(
    staged: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str], all_columns: bool
) -> DataFrame:
    """The staged rows in the table's types, once everything named is known to be there."""
    if not keys:
        raise ValueError("upsert and update match rows by keys; none are given")
    target = staged.sparkSession.table(table).columns
    for named in (keys, columns):
        _require(named, target, table)
        _require(named, staged.columns, "the staged table")
    if all_columns:
        _require(target, staged.columns, "the staged table")
    return _retyped(staged, table)


def upsert(
    staged: DataFrame, table: str, keys: Sequence[str], condition: str | None = None,
    update_columns: Sequence[str] | None = None, update_when: str | None = None,
    keep_old: bool = False, version: str | None = None,
) -> None:
    """``version`` names this load: given again, after whatever interruption, it changes nothing more.

    Only the table's last version is remembered, so loads that may be repeated come one after another.
    """
    spark = staged.sparkSession
    condition = (condition or "").strip() or None
    staged = _checked(staged, table, keys, update_columns or (), all_columns=True)
    found = _format(spark, table)
    if found in FILE_FORMATS and _done_before(spark, table, version, keep_old):
        return
    if found in MERGING_FORMATS:
        columns = spark.table(table).columns
        chosen = columns if update_columns is None else update_columns
        updates = [c for c in chosen if c not in NEVER_UPDATED]
        _merge(staged.select(*columns), table, keys=keys, condition=condition, updates=updates,
               update_when=update_when)
        return
    check_single_source(spark.table(table), staged, keys, condition)
    _rewrite(
        spark, table, staged, keys,
        lambda target: merged_parts(target, staged, keys, condition, update_columns, update_when),
        adds_rows=True, sets=staged.columns if update_columns is None else update_columns, keep_old=keep_old,
        version=version,
    )


def update(
    staged: DataFrame, table: str, keys: Sequence[str], update_columns: Sequence[str],
    condition: str | None = None, keep_old: bool = False,
) -> None:
    if not update_columns:
        raise ValueError("update needs at least one column to set")
    spark = staged.sparkSession
    condition = (condition or "").strip() or None
    staged = _checked(staged, table, keys, update_columns, all_columns=False)
    if _format(spark, table) in MERGING_FORMATS:
        _merge(staged, table, keys=keys, condition=None, updates=update_columns,
               update_when=condition, inserts=False)
        return
    check_single_source(spark.table(table), staged, keys)
    _rewrite(
        spark, table, staged, keys,
        lambda target: [updated(target, staged, keys, update_columns, condition)],
        adds_rows=False, sets=update_columns, keep_old=keep_old,
    )


def load(
    staged: DataFrame, table: str, mode: str, partition_by: Sequence[str] = (),
    keys: Sequence[str] = (), condition: str | None = None,
    update_columns: Sequence[str] | None = None, update_when: str | None = None, version: str | None = None,
) -> None:
    """Load by the configured mode, whatever its case.

    An overwrite by partitions must name the columns the table is partitioned by.
    ``update_when`` is asked of the rows an upsert or update matches; ``version`` keeps a repeated upsert from
    inserting again. The other modes repeat themselves, but for append.
    """
    kind = mode.lower()
    if kind == "full_load" or (kind == "overwrite" and not partition_by):
        full_load(staged, table, partition_by)
    elif kind == "overwrite":
        own = _partition_columns(staged.sparkSession, table)
        if sorted(map(str.lower, partition_by)) != sorted(map(str.lower, own)):
            raise ValueError(f"{table} is partitioned by {own}, not by {list(partition_by)}")
        overwrite_partitions(staged, table)
    elif kind == "append":
        append(staged, table)
    elif kind == "upsert":
        upsert(staged, table, keys, condition, update_columns, update_when, version=version)
    elif kind == "update":
        both = " AND ".join(f"({c})" for c in (condition, update_when) if (c or "").strip())
        update(staged, table, keys, update_columns or (), both)
    else:
        raise ValueError(f"unsupported load mode: {mode}")
