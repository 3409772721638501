"""The whole run: raw records to facts, store, questions, quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.model import SOURCES, SourceSpec, enabled_sources
from renown.operators.checks import absent_columns, passes, validation_report
from renown.operators.identity import canonicalize_names
from renown.operators.normalize import accepted, normalize_lines, rejected
from renown.plans.queries import all_queries
from renown.sources import versions
from renown.sources.dims import entity_dim
from renown.sources.files import work_folder
from renown.sources.quarantine import write_quarantine
from renown.sources.raw import raw_lines
from renown.sources.snapshots import (
    newest_date,
    scan_entity,
    scan_snapshots,
    stored_columns,
    write_version,
)

MODES = ("full", "query", "validate")


class QualityGateError(RuntimeError):
    """The newest snapshot failed a check."""


@dataclass
class Outcome:
    """What a run produced; queries and report are lazy DataFrames."""

    queries: dict[str, DataFrame]
    report: DataFrame | None


def ingest_snapshot(
    spark: SparkSession,
    raw_root: str,
    store_root: str,
    quarantine_root: str,
    snapshot_date,
    dim: DataFrame,
    specs: Sequence[SourceSpec] = SOURCES,
    max_tags: int | None = None,
) -> None:
    """Normalise one landed date and store it; broken records go to quarantine.

    The raw JSON is parsed once: the mapped rows are written to a work table in
    the shared folder, split by outcome, and both sinks read their part from there. Both sinks
    are complete before the first of the two pointers moves, the quarantine's, so a failure
    leaves the old facts and at most shows new reasons beside them.
    """
    lines = raw_lines(spark, raw_root)
    normalized = normalize_lines(lines, snapshot_date, dim, max_tags, enabled_sources(specs))
    outcome = F.col("reject_reason").isNotNull().alias("is_rejected")
    with work_folder(spark) as staged_at:
        normalized.select("*", outcome).write.partitionBy("is_rejected").parquet(staged_at)
        schema = normalized.schema.add("is_rejected", "boolean")
        staged = spark.read.schema(schema).parquet(staged_at)
        broken = write_quarantine(rejected(staged.where("is_rejected")), quarantine_root, snapshot_date)
        facts = accepted(staged.where(~F.col("is_rejected")))
        stored, dates = write_version(facts, store_root, snapshot_date)
    versions.publish(spark, quarantine_root, [str(snapshot_date)], broken)
    versions.publish(spark, store_root, dates, stored)


def load_facts(spark: SparkSession, store_root: str, dim: DataFrame, dates=None) -> DataFrame:
    """Stored snapshots, all or some dates, under today's canonical names; null names stay null."""
    return canonicalize_names(scan_snapshots(spark, store_root, dates), dim, unknown=None)


def load_profile(spark: SparkSession, store_root: str, dim: DataFrame, name: str) -> DataFrame:
    """All stored facts of one name. The stored key cuts first, names are settled on what is left."""
    return canonicalize_names(scan_entity(spark, store_root, name), dim, unknown=None)


def run(
    spark: SparkSession,
    mode: str,
    store_root: str,
    entities: DataFrame,
    profile_of: str,
    snapshot_date=None,
    raw_root: str | None = None,
    quarantine_root: str | None = None,
    specs: Sequence[SourceSpec] = SOURCES,
    skip_validation: bool = False,
    whole: bool = False,
    max_tags: int | None = None,
) -> Outcome:
    """Run the stages a mode asks for.

    ``full`` stores the landed date first, today if none is named; ``query`` and ``validate`` work on
    what is stored, ``validate`` without the queries. The gate runs unless
    ``skip_validation`` is set and raises QualityGateError when a check fails.
    ``whole`` gives the questions' whole answers, unsorted, in place of their top lists. All tags
    of a record are stored unless ``max_tags`` is set.

    Only the profile looks at more than the newest date, by the stored key; the published view spans all
    dates and reads nothing until it is asked.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    dim = entity_dim(entities)
    sources = enabled_sources(specs)
    if mode == "full":
        if snapshot_date is None:
            snapshot_date = spark.sql("SELECT current_date()").first()[0]
        ingest_snapshot(spark, raw_root, store_root, quarantine_root, snapshot_date, dim, specs, max_tags)

    as_of = newest_date(spark, store_root, sources)
    days = [] if as_of is None else [as_of]
    latest = load_facts(spark, store_root, dim, days)
    queries = {}
    if mode != "validate":
        history = load_facts(spark, store_root, dim)
        profile = load_profile(spark, store_root, dim, profile_of)
        queries = all_queries(history, sources, profile_of, as_of, whole, latest, profile)
    if skip_validation:
        return Outcome(queries, None)
    # What the files lack must not pass as null, so the gate sees the columns that are there.
    absent = absent_columns(stored_columns(spark, store_root, days))
    report = validation_report(latest.drop(*absent), entities, specs, as_of)
    if not passes(report):
        raise QualityGateError(f"snapshot {as_of} failed validation")
    return Outcome(queries, report)
