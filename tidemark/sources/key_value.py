"""Key/value tables read as one typed row per entity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_rows(
    pairs: DataFrame, types: Mapping[str, str], entity: str = "entity",
    key: str = "key", value: str = "value",
) -> DataFrame:
    """One row per entity with a column per listed key; an absent key is null.

    ``types`` lists the keys and their Spark types. Listing them keeps the pivot to one
    aggregation, combined map-side, instead of a first pass that looks for keys.
    """
    wide = pairs.groupBy(entity).pivot(key, list(types)).agg(F.first(value, ignorenulls=True))
    return wide.select(entity, *[F.col(k).try_cast(t).alias(k) for k, t in types.items()])
