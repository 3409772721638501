import datetime
import random

from renown.model import FACT_SCHEMA, SourceSpec
from renown.operators.checks import passes, validation_report

DAY = datetime.date(2026, 4, 26)
SPECS = (
    SourceSpec("a", required=True, min_coverage=0.9),
    SourceSpec("b", required=True, max_score=100),
    SourceSpec("c", min_coverage=0.5),
    SourceSpec("off", enabled=False, required=True),
)


def expected(spark, n):
    return spark.createDataFrame([(f"e{i}",) for i in range(n)], "entity_name string")


def report(spark, rows, n, **options):
    facts = spark.createDataFrame(rows, FACT_SCHEMA)
    made = validation_report(facts, expected(spark, n), SPECS, min_sources=2, **options)
    found = made.orderBy("position").collect()
    return {(r.check, r.source): (r.passed, r.observed, r.threshold) for r in found}, made


def row(name, source, score=1, day=DAY, entity_id="1", reach=1):
    return (name, entity_id, source, day, score, reach, None, None)


def test_clean_snapshot_passes(spark):
    rows = [row(f"e{i}", s) for i in range(10) for s in "abc"]
    rows += [row("stale", "a", day=datetime.date(2026, 4, 1)), row("x", "off", score=-5)]
    checks, made = report(spark, rows, 10)
    assert all(passed for passed, _, _ in checks.values())
    assert checks[("coverage", "a")] == (True, 1.0, 0.9)
    assert checks[("metric rows", "b")] == (True, 10.0, 9.0)
    assert ("coverage", "b") not in checks
    assert passes(made)


def test_each_fault_is_seen(spark):
    rows = [row(f"e{i}", "a") for i in range(8)]
    rows += [row("e1", "a"), row(None, "a"), row("odd", "c", entity_id=None), row("e2", "c", -1)]
    rows += [row("e3", "b", score=101), row("e3", None), row("e4", "b", score=None, reach=-2)]
    checks, made = report(spark, rows, 10)
    # A row without a source is outside the enabled ones.
    assert checks == {
        ("columns present", None): (True, 0, 0),
        ("keys filled", None): (False, 2, 0),
        ("entity count", None): (True, 10, 10),
        ("names in list", None): (False, 1, 0),
        ("no duplicates", None): (False, 1, 0),
        ("source count", None): (True, 3, 2),
        ("required sources present", None): (True, 0, 0),
        ("coverage", "a"): (True, 1.0, 0.9),
        ("coverage", "c"): (False, 0.2, 0.5),
        ("no metric below zero", None): (False, 2, 0),
        ("required sources scored", None): (True, 0, 0),
        ("metric rows", "a"): (True, 10, 9),
        ("metric rows", "b"): (False, 1, 9),
        ("bounded scores", None): (False, 1, 0),
        ("overall", None): (False, 7, 0),
    }
    assert not passes(made)


def test_absent_source_and_metrics(spark):
    checks, _ = report(spark, [row("e0", "b", score=None)], 1)
    assert checks[("required sources present", None)] == (False, 1, 0)
    assert checks[("required sources scored", None)] == (False, 2, 0)
    assert checks[("metric rows", "a")] == (True, 0, 0)
    assert ("coverage", "a") not in checks


def test_empty_table_and_missing_columns(spark):
    checks, made = report(spark, [], 3)
    assert checks[("entity count", None)] == (False, 0, 3)
    assert not passes(made)
    bare = spark.createDataFrame([("e0",)], "entity_name string")
    short = validation_report(bare, expected(spark, 1), SPECS)
    assert [(r.check, r.passed, r.observed) for r in short.collect()] == [
        ("columns present", False, 7.0),
        ("overall", False, 1.0),
    ]


def test_counts_match_brute_force(spark):
    rng = random.Random(3)
    rows = [
        row(
            rng.choice([None, "odd", *[f"e{i}" for i in range(30)]]),
            rng.choice("aaab"),
            rng.choice([None, -3, 5, 120]),
            entity_id=rng.choice(["1", None]),
            reach=rng.choice([None, 4, -4]),
        )
        for _ in range(200)
    ]
    checks, _ = report(spark, rows, 30)
    observed = {key: value[1] for key, value in checks.items()}
    groups = [(r[0], r[2]) for r in rows]
    assert observed[("keys filled", None)] == sum(r[0] is None or r[1] is None for r in rows)
    assert observed[("entity count", None)] == len({r[0] for r in rows})
    assert observed[("no duplicates", None)] == sum(
        groups.count(group) > 1 for group in set(groups)
    )
    assert observed[("no metric below zero", None)] == sum(
        (r[4] or 0) < 0 or (r[5] or 0) < 0 for r in rows
    )
    assert observed[("bounded scores", None)] == sum(
        r[2] == "b" and r[4] is not None and not 0 <= r[4] <= 100 for r in rows
    )
    assert observed[("metric rows", "a")] == sum(r[2] == "a" and r[4] is not None for r in rows)
