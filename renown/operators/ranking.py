"""Exact percent ranks and dense ranks without one task per signal.

A window over ``PARTITION BY signal`` sends each signal to one task, whatever
its size. Here the ranks are worked out on the counts per distinct value, and
the values are cut into three digits of 21 bits. Ranks follow from three prefix
sums: over the leading digit, over the middle digit within it and over the
values within both. So no window partition ever has more than 2**21 rows, for
any distribution of the data and without sampling. A value shared by a third of
all entities collapses to one row before the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DIGIT_BITS = 21


def _running(df: DataFrame, group: list[str], order: str, suffix: str) -> DataFrame:
    """Rows and distinct values before each row of its group."""
    before = (
        Window.partitionBy(*group)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumns(
        {
            f"rows_{suffix}": F.coalesce(F.sum("n_rows").over(before), F.lit(0)),
            f"values_{suffix}": F.coalesce(F.sum("n_values").over(before), F.lit(0)),
        }
    )


def _ranked_rows(metrics: DataFrame) -> DataFrame:
    """The rows that take part: metric present and positive."""
    return metrics.where(F.col("signal").isNotNull() & F.col("value").isNotNull() & (F.col("value") > 0))


def value_ranks(metrics: DataFrame) -> DataFrame:
    """(signal, value, percentile, signal_rank) for every distinct positive value.

    ``percentile`` is the share of the other rows that lie strictly below,
    0.0 for a lone row. ``signal_rank`` is the dense rank, largest value first.
    """
    # Never null, so that all three levels share one plan below the first
    # shuffle and Spark runs it once.
    value = F.coalesce(F.col("value"), F.lit(0))
    values = (
        _ranked_rows(metrics)
        .groupBy("signal", "value")
        .agg(F.count("*").alias("n_rows"))
        .select(
            "signal",
            "value",
            F.shiftright(value, 2 * _DIGIT_BITS).alias("high"),
            F.shiftright(value, _DIGIT_BITS).alias("middle"),
            "n_rows",
            F.lit(1).cast("long").alias("n_values"),
        )
    )
    sums = [F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values")]
    middles = values.groupBy("signal", "high", "middle").agg(*sums)
    highs = middles.groupBy("signal", "high").agg(*sums)

    whole = Window.partitionBy("signal")
    high_offsets = _running(highs, ["signal"], "high", "high").select(
        "signal",
        "high",
        "rows_high",
        "values_high",
        F.sum("n_rows").over(whole).alias("total_rows"),
        F.sum("n_values").over(whole).alias("total_values"),
    )
    middle_offsets = (
        _running(middles, ["signal", "high"], "middle", "middle")
        .drop("n_rows", "n_values")
        .join(high_offsets, ["signal", "high"])
    )
    ranked = _running(values, ["signal", "high", "middle"], "value", "value").join(
        middle_offsets, ["signal", "high", "middle"]
    )

    below = F.col("rows_high") + F.col("rows_middle") + F.col("rows_value")
    smaller = F.col("values_high") + F.col("values_middle") + F.col("values_value")
    others = F.col("total_rows") - 1
    return ranked.select(
        "signal",
        "value",
        F.when(others == 0, F.lit(0.0)).otherwise(below / others).alias("percentile"),
        (F.col("total_values") - smaller).alias("signal_rank"),
    )


def rank_signals(metrics: DataFrame) -> DataFrame:
    """Each positive metric row with its percentile and dense rank.

    Input is (entity_name, signal, value). The join back is one row per value
    on the right; a crowded value is split by the adaptive skew join.
    """
    return _ranked_rows(metrics).join(value_ranks(metrics), ["signal", "value"])


def signal_percentile(metrics: DataFrame) -> DataFrame:
    """(entity_name, signal, metric_value, percentile)."""
    return rank_signals(metrics).select(
        "entity_name", "signal", F.col("value").cast("double").alias("metric_value"), "percentile"
    )


def signal_dense_rank(metrics: DataFrame) -> DataFrame:
    """(entity_name, signal, signal_rank), 1 for the largest value."""
    return rank_signals(metrics).select("entity_name", "signal", "signal_rank")
