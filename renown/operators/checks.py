"""Data-quality checks on one snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.model import (
    DEFAULT_METRIC_COVERAGE,
    FACT_COLUMNS,
    FACT_SCHEMA,
    MIN_SOURCE_COUNT,
    SOURCES,
    SourceSpec,
)
from renown.operators.snapshot import enabled_only, latest_snapshot

OVERALL = "overall"


def has_null_key() -> Column:
    keys = ("entity_name", "entity_id", "source", "snapshot_date")
    return F.greatest(*[F.col(key).isNull() for key in keys])


def has_negative_metric() -> Column:
    metrics = ("score", "reach", "volume")
    return F.greatest(*[F.coalesce(F.col(m) < 0, F.lit(False)) for m in metrics])


def is_out_of_bounds(specs: Sequence[SourceSpec] = SOURCES) -> Column:
    """Score outside 0..max of a source that has a maximum."""
    bounded = [
        (F.col("source") == s.name) & ~F.col("score").between(0, s.max_score)
        for s in specs
        if s.max_score is not None
    ]
    return F.coalesce(*[F.when(bad, F.lit(True)) for bad in bounded], F.lit(False))


def null_key_rows(facts: DataFrame) -> DataFrame:
    return facts.where(has_null_key())


def negative_rows(facts: DataFrame) -> DataFrame:
    return facts.where(has_negative_metric())


def out_of_bounds_rows(facts: DataFrame, specs: Sequence[SourceSpec] = SOURCES) -> DataFrame:
    return facts.where(is_out_of_bounds(specs))


def distinct_entities(facts: DataFrame) -> DataFrame:
    return facts.select("entity_name").distinct()


def unexpected_names(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct names outside the expected list; a null name does not count."""
    return (
        distinct_entities(facts)
        .where(F.col("entity_name").isNotNull())
        .join(expected.select("entity_name"), "entity_name", "left_anti")
    )


def duplicate_groups(facts: DataFrame) -> DataFrame:
    """(entity, source, date) groups with more than one row, and their size."""
    return (
        facts.groupBy("entity_name", "source", "snapshot_date")
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def source_counts(facts: DataFrame) -> DataFrame:
    """Rows per source."""
    return facts.groupBy("source").agg(F.count("*").alias("n_rows"))


def _least_coverage(specs: Sequence[SourceSpec], default: float | None = None) -> Column:
    """The minimum of the row's source as an expression over the short config."""
    chain = F.lit(default).cast("double")
    for s in specs:
        if s.min_coverage is not None:
            chain = F.when(F.col("source") == s.name, F.lit(s.min_coverage)).otherwise(chain)
    return chain


def coverage_by_source(
    facts: DataFrame, expected: DataFrame, specs: Sequence[SourceSpec] = SOURCES
) -> DataFrame:
    """Rows per source against the number of expected entities and the minimum.

    ``passed`` is null for a source without a minimum.
    """
    n_expected = expected.agg(F.count("*").alias("n")).scalar()
    share = F.when(F.col("n_expected") > 0, F.col("n_rows") / F.col("n_expected")).otherwise(
        F.lit(0.0)
    )
    return (
        source_counts(facts)
        .withColumn("n_expected", n_expected)
        .withColumn("coverage", share)
        .withColumn("min_coverage", _least_coverage(specs))
        .withColumn("passed", F.col("coverage") >= F.col("min_coverage"))
    )


def _row(check: str, passed: Column, observed: Column, threshold: Column, source=None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(source).cast("string").alias("source"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        threshold.cast("double").alias("threshold"),
    )


def missing_columns_report(stored: DataFrame) -> DataFrame:
    """Per date and expected column, whether its files hold it: (snapshot_date, column, expected_type, stored_type, passed).

    ``stored`` has one row per date and column of the files, as ``stored_columns`` gives them. A column
    of another type does not pass. The date itself is a folder, not a column of the files.
    """
    expected = [f for f in FACT_SCHEMA.fields if f.name != "snapshot_date"]
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("expected_type"))
                for f in expected
            ]
        )
    )
    dates = stored.select("snapshot_date").distinct().select("snapshot_date", wanted.alias("w"))
    return (
        dates.select("snapshot_date", "w.*")
        .join(stored.select("snapshot_date", "column", "stored_type"), ["snapshot_date", "column"], "left")
        .withColumn("passed", F.coalesce(F.col("stored_type") == F.col("expected_type"), F.lit(False)))
    )


def absent_columns(stored: DataFrame) -> list[str]:
    """Fact columns that the files of some date lack, at most the width of a fact."""
    lacking = missing_columns_report(stored).where(F.col("stored_type").isNull())
    return sorted(r["column"] for r in lacking.select("column").distinct().collect())


def missing_columns(facts: DataFrame) -> list[str]:
    return sorted(set(FACT_COLUMNS) - set(facts.columns))


def validation_report(
    facts: DataFrame,
    expected: DataFrame,
    specs: Sequence[SourceSpec] = SOURCES,
    as_of=None,
    dates: DataFrame | None = None,
    min_sources: int = MIN_SOURCE_COUNT,
    default_coverage: float = DEFAULT_METRIC_COVERAGE,
) -> DataFrame:
    """All checks on the newest snapshot as (position, check, source, passed, observed, threshold).

    One job and two scans: the snapshot is counted per (entity, source), which
    makes the duplicates visible, and per source from these groups; a second scan
    reads the names alone. What follows has one row per source, and sources are
    limited to the enabled ones. The last row, ``overall``, is true when all
    others are.
    """
    absent = missing_columns(facts)
    if absent:
        verdict = [
            _row("columns present", F.lit(False), F.lit(len(absent)), F.lit(0)),
            _row(OVERALL, F.lit(False), F.lit(1), F.lit(0)),
        ]
        return facts.sparkSession.range(1).select(
            F.posexplode(F.array(*verdict)).alias("position", "r")
        ).select("position", "r.*")

    enabled = [s for s in specs if s.enabled]
    names = [s.name for s in enabled]
    latest = latest_snapshot(
        enabled_only(facts, names), as_of, None if dates is None else enabled_only(dates, names)
    )
    groups = latest.groupBy("entity_name", "source").agg(
        F.count("*").alias("n_rows"),
        F.count_if(has_null_key()).alias("null_keys"),
        F.count_if(has_negative_metric()).alias("negative"),
        F.count_if(is_out_of_bounds(enabled)).alias("out_of_bounds"),
        F.count("score").alias("scored"),
    )
    per_source = groups.groupBy("source").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "null_keys", "negative", "out_of_bounds", "scored")],
        F.count_if(F.col("n_rows") > 1).alias("duplicates"),
    )
    wanted = expected.select("entity_name").distinct().withColumn("is_expected", F.lit(True))
    entities = (
        groups.select("entity_name")
        .distinct()
        .join(wanted, "entity_name", "left")
        .agg(
            F.struct(
                F.count("*").alias("present"),
                F.count_if(
                    F.col("is_expected").isNull() & F.col("entity_name").isNotNull()
                ).alias("unexpected"),
            ).alias("entities")
        )
    )
    counts = per_source.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("null_keys", "negative", "out_of_bounds", "duplicates")
        ],
        F.count("source").alias("n_sources"),
        F.map_from_entries(
            F.collect_list(
                F.when(
                    F.col("source").isNotNull(), F.struct("source", F.struct("n_rows", "scored"))
                )
            )
        ).alias("by_source"),
    ).select(
        "*",
        entities.scalar().alias("entities"),
        expected.agg(F.count("*").alias("n")).scalar().alias("n_expected"),
    )

    n_expected = F.col("n_expected")
    stats = {s.name: F.element_at("by_source", F.lit(s.name)) for s in enabled}
    rows_of = {name: stats[name]["n_rows"] for name in names}
    scored_of = {name: F.coalesce(stats[name]["scored"], F.lit(0)) for name in names}
    required = sorted(s.name for s in enabled if s.required)
    least = {s.name: s.min_coverage for s in enabled}

    def zero_violations(check: str, column: str | Column) -> Column:
        observed = F.col(column) if isinstance(column, str) else column
        return _row(check, observed == 0, observed, F.lit(0))

    def missing(flags: list[Column]) -> Column:
        return sum((flag.cast("int") for flag in flags), F.lit(0))

    checks = [
        _row("columns present", F.lit(True), F.lit(0), F.lit(0)),
        zero_violations("keys filled", "null_keys"),
        _row(
            "entity count",
            F.col("entities.present") == n_expected,
            F.col("entities.present"),
            n_expected,
        ),
        zero_violations("names in list", "entities.unexpected"),
        zero_violations("no duplicates", "duplicates"),
        _row("source count", F.col("n_sources") >= min_sources, F.col("n_sources"), F.lit(min_sources)),
        zero_violations(
            "required sources present", missing([rows_of[name].isNull() for name in required])
        ),
    ]
    for name in sorted(names):
        if least[name] is not None:
            share = F.when(n_expected > 0, rows_of[name] / n_expected).otherwise(F.lit(0.0))
            covered = _row("coverage", share >= least[name], share, F.lit(least[name]), name)
            checks.append(F.when(rows_of[name].isNotNull(), covered))
    checks.append(zero_violations("no metric below zero", "negative"))
    checks.append(
        zero_violations(
            "required sources scored", missing([scored_of[name] == 0 for name in required])
        )
    )
    for name in required:
        share = default_coverage if least[name] is None else least[name]
        floor = F.floor(n_expected * F.lit(share))
        checks.append(
            _row("metric rows", scored_of[name] >= floor, scored_of[name], floor, name)
        )
    checks.append(zero_violations("bounded scores", "out_of_bounds"))

    made = F.array_compact(F.array(*checks))
    failed = F.size(F.filter(made, lambda check: ~check["passed"]))
    overall = _row(OVERALL, failed == 0, failed, F.lit(0))
    return counts.select(
        F.posexplode(F.concat(made, F.array(overall))).alias("position", "r")
    ).select("position", "r.*")


def passes(report: DataFrame) -> bool:
    """The verdict of a report."""
    return bool(report.where(F.col("check") == OVERALL).first()["passed"])
