"""A staged backlog of several control dates, folded into one load.

Loading date by date rewrites a target once for each date. For most modes the rows that the last
of these loads leaves can be told beforehand, so the backlog becomes one staged table whose single load leaves
the target as the loads one after another would.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.loads import NEVER_UPDATED


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def repeats(staged: DataFrame, order: str, keys: Sequence[str]) -> bool:
    """Is a key staged more than once on one date?

    Such rows update one target row together, which is refused, or are inserted side by side: that depends on
    what the dates before left, so they cannot be folded.
    """
    counted = staged.filter(_keyed(keys)).groupBy(order, *keys).count()
    return not counted.filter("count > 1").isEmpty()


def last_date(staged: DataFrame, order: str, last: datetime) -> DataFrame:
    """Of a table replaced by each date, what the last one leaves, even if it stages nothing."""
    return staged.filter(F.col(order) == F.lit(last).cast("timestamp_ntz"))


def last_date_per_partition(staged: DataFrame, order: str, partition_by: Sequence[str]) -> DataFrame:
    """Of partitions replaced by each date that holds them, what the last such date leaves."""
    newest = staged.groupBy(*partition_by).agg(F.max(order).alias(order)).alias("last")
    same = [F.col(f"row.{c}").eqNullSafe(F.col(f"last.{c}")) for c in [*partition_by, order]]
    return staged.alias("row").join(newest, same, "left_semi")


def newest_per_key(
    staged: DataFrame, order: str, keys: Sequence[str], updated: Sequence[str], inserts: bool
) -> DataFrame:
    """One row for each key: ``updated`` columns of its newest date, the others of its oldest.

    A key is inserted by its oldest date and then only its updated columns change. A null key matches
    nothing, so its rows are inserted by every date, or ignored where nothing is inserted. A key
    comes once a date, so a window over a key holds no more rows than there are dates.
    """
    of_key = Window.partitionBy(*keys)
    through = of_key.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = staged.filter(_keyed(keys))
    first = [F.first(c).over(through).alias(c) if c not in updated and c not in keys else F.col(c)
             for c in staged.columns if c != order]
    newest = (
        keyed.select(*first, F.col(order), F.max(order).over(of_key).alias("_newest"))
        .filter(F.col(order) == F.col("_newest")).select(*staged.columns)
    )
    return newest.unionByName(staged.filter(~_keyed(keys))) if inserts else newest


def fold(
    staged: DataFrame, order: str, last: datetime, mode: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (),
    condition: str | None = None, update_columns: Sequence[str] | None = None,
) -> DataFrame | None:
    """The one staged table for all dates, or None where only loading date by date is right.

    ``staged`` holds every date's rows with their run's own time in ``order``; ``last`` is that of the
    last run. Conditions compare staged with target rows as each date finds them, and keys repeated within a date
    depend on what is there already: both need the dates one by one.
    """
    kind = mode.lower()
    if kind == "append":
        folded = staged
    elif kind == "full_load" or (kind == "overwrite" and not partition_by):
        folded = last_date(staged, order, last)
    elif kind == "overwrite":
        folded = last_date_per_partition(staged, order, partition_by)
    elif kind in ("upsert", "update") and keys and not (condition or "").strip() and not repeats(staged, order, keys):
        chosen = [c for c in staged.columns if c != order] if update_columns is None else update_columns
        upserts = kind == "upsert"
        updated = [c for c in chosen if c not in NEVER_UPDATED] if upserts else chosen
        folded = newest_per_key(staged, order, keys, updated, upserts)
    else:
        return None
    return folded.drop(order)
