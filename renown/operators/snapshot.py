"""Which rows a query looks at."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.model import FACT_COLUMNS, VIEW_COLUMNS


def enabled_only(facts: DataFrame, sources: Iterable[str] | None) -> DataFrame:
    """Rows of the sources switched on; no list keeps everything."""
    return facts.where(F.col("source").isin(sorted(sources))) if sources else facts


def latest_snapshot(
    facts: DataFrame, as_of: datetime.date | str | None = None, dates: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest snapshot date over all sources.

    ``as_of`` names a date already known. Otherwise it is the maximum over
    ``dates`` (any table with the same ``snapshot_date`` values that is cheaper
    to read), by default over the facts themselves.
    """
    if as_of is not None:
        newest = F.lit(as_of).cast("date")
    else:
        dates = facts if dates is None else dates
        newest = dates.agg(F.max("snapshot_date").alias("newest")).scalar()
    return facts.where(F.col("snapshot_date") == newest)


def publish_view(
    facts: DataFrame, sources: Iterable[str] | None = None, view: str = "artist_popularity"
) -> DataFrame:
    """Publish the enabled rows as a temporary view for hand-written SQL."""
    kept = enabled_only(facts, sources)
    kept.select(
        *[F.col(name).alias(VIEW_COLUMNS[name]) for name in FACT_COLUMNS]
    ).createOrReplaceTempView(view)
    return kept
