"""Metrics of several sources side by side."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.model import SIGNALS, TAG_PRIORITY, Metric


def of_source(source: str, column: str) -> Column:
    """The largest value a source gives an entity, as an aggregate."""
    return F.max(F.when(F.col("source") == source, F.col(column)))


def _by_source(signals: Sequence[Metric], choose) -> Column:
    """A CASE over the row's source."""
    chain = F.when(F.col("source") == signals[0].source, choose(signals[0]))
    for s in signals[1:]:
        chain = chain.when(F.col("source") == s.source, choose(s))
    return chain


def metric_rows(facts: DataFrame, signals: Sequence[Metric] = SIGNALS) -> DataFrame:
    """(entity_name, signal, value) in one scan of the facts.

    ``value`` is the exact BIGINT and null values give no row. A row belongs to
    one source, so with one signal per source this is a plain projection; only
    a source that feeds several signals needs rows to be multiplied.
    """
    sources = {s.source for s in signals}
    relevant = facts.where(F.col("source").isin(sorted(sources)))
    if len(sources) == len(signals):
        rows = relevant.select(
            "entity_name",
            _by_source(signals, lambda s: F.lit(s.name)).alias("signal"),
            _by_source(signals, lambda s: F.col(s.column)).alias("value"),
        )
    else:
        cells = [
            F.when(
                F.col("source") == s.source,
                F.struct(F.lit(s.name).alias("signal"), F.col(s.column).alias("value")),
            )
            for s in signals
        ]
        rows = relevant.select("entity_name", F.inline(F.array_compact(F.array(*cells))))
    return rows.where(F.col("value").isNotNull())


def metric_signals(facts: DataFrame, signals: Sequence[Metric] = SIGNALS) -> DataFrame:
    """Wide metrics as (entity_name, signal, metric_value DOUBLE)."""
    return metric_rows(facts, signals).select(
        "entity_name", "signal", F.col("value").cast("double").alias("metric_value")
    )


def pivot_metrics(facts: DataFrame, metrics: Iterable[Metric], *extra: Column) -> DataFrame:
    """One row per entity, one column per metric; combines before the shuffle."""
    return facts.groupBy("entity_name").agg(
        *[of_source(m.source, m.column).alias(m.name) for m in metrics], *extra
    )


def priority_tags(priority: Iterable[str] = TAG_PRIORITY) -> Column:
    """Tags of the first source in the list that has any, as an aggregate."""
    return F.coalesce(*[of_source(source, "tags") for source in priority])
