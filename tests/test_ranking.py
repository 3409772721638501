import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from renown.model import Metric
from renown.operators.ranking import rank_signals
from renown.operators.signals import metric_rows


def by_window(metrics):
    signal = Window.partitionBy("signal")
    return metrics.where("value > 0").select(
        "entity_name",
        "signal",
        F.percent_rank().over(signal.orderBy("value")).alias("percentile"),
        F.dense_rank().over(signal.orderBy(F.desc("value"))).cast("long").alias("signal_rank"),
    )


def test_ranks_equal_the_window_functions(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        magnitude = rng.choice([3, 20, 21, 22, 41, 42, 43, 60, 62])
        value = 1 if rng.random() < 0.33 else rng.randint(0, 2**magnitude)
        rows.append((f"e{i}", rng.choice("aaab"), value))
    rows += [("lone", "c", 5), ("zero", "d", 0), ("below", "d", -4), ("none", "d", None)]
    rows += [("low", "e", 2**42 - 1), ("next", "e", 2**42), ("top", "e", 2**63 - 1)]
    metrics = spark.createDataFrame(rows, "entity_name string, signal string, value long")
    columns = ["entity_name", "signal", "percentile", "signal_rank"]
    ours = sorted(rank_signals(metrics).select(*columns).collect())
    assert ours == sorted(by_window(metrics).collect())
    assert [(r.percentile, r.signal_rank) for r in ours if r.signal == "c"] == [(0.0, 1)]
    assert not [r for r in ours if r.signal == "d"]


def test_crowded_value_and_leading_rank(spark):
    rows = [(f"e{i}", "s", 10 if i % 3 else i + 11) for i in range(300)]
    metrics = spark.createDataFrame(rows, "entity_name string, signal string, value long")
    ranked = {r.entity_name: r for r in rank_signals(metrics).collect()}
    assert {ranked[f"e{i}"].percentile for i in range(300) if i % 3} == {0.0}
    assert ranked["e297"].signal_rank == 1 and ranked["e297"].percentile == 1.0
    assert ranked["e1"].signal_rank == 101


def test_a_source_may_feed_several_signals(spark):
    facts = spark.createDataFrame(
        [("x", "s", 1, 2), ("y", "t", None, 4), ("z", "u", 7, 7)],
        "entity_name string, source string, score long, reach long",
    )
    signals = (Metric("a", "s", "score"), Metric("b", "s", "reach"), Metric("c", "t", "reach"))
    rows = [tuple(r) for r in metric_rows(facts, signals).collect()]
    assert sorted(rows) == [("x", "a", 1), ("x", "b", 2), ("y", "c", 4)]
    rows = [tuple(r) for r in metric_rows(facts, signals[::2]).collect()]
    assert sorted(rows) == [("x", "a", 1), ("y", "c", 4)]
