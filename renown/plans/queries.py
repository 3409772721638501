"""The analytical questions. Each takes facts already cut to what it should see.

All but the profile expect the newest snapshot of the enabled sources. ``n`` is
the length of a top list; ``None`` returns the whole, unsorted answer.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.model import (
    ENRICHMENT_SOURCES,
    ENRICHMENT_TAG_ORDER,
    PERCENTILE_COLUMNS,
    PROFILE_ORDER,
    SCORECARD,
    SCORECARD_SORT,
    SIGNALS,
    STOP_TAGS,
    TAG_METRICS,
    TAG_PRIORITY,
    Metric,
)
from renown.operators.ranking import rank_signals
from renown.operators.signals import metric_rows, of_source, pivot_metrics, priority_tags
from renown.operators.snapshot import enabled_only, latest_snapshot, publish_view


def _top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    return df if n is None else df.orderBy(*order).limit(n)


def scorecard(
    facts: DataFrame,
    n: int | None = 50,
    metrics: Sequence[Metric] = SCORECARD,
    sort: Sequence[str] = SCORECARD_SORT,
    tag_priority: Sequence[str] = TAG_PRIORITY,
) -> DataFrame:
    """One wide row per entity: its metrics and the tags of the best source."""
    wide = pivot_metrics(facts, metrics, priority_tags(tag_priority).alias("primary_tags"))
    return _top(wide, n, *[F.desc_nulls_last(c) for c in sort], F.asc("entity_name"))


def composite_reach(
    facts: DataFrame,
    n: int | None = 25,
    signals: Sequence[Metric] = SIGNALS,
    columns: Mapping[str, str] = PERCENTILE_COLUMNS,
) -> DataFrame:
    """Mean percentile over the signals an entity has, times 100.

    The mean is put together from one sum per signal in a fixed order, so the
    last digit does not depend on how rows were spread over tasks.
    """
    ranked = rank_signals(metric_rows(facts, signals))

    def share(s: Metric) -> Column:
        return F.when(F.col("signal") == s.name, F.col("percentile"))

    sums = ranked.groupBy("entity_name").agg(
        F.count("*").alias("metric_signals"),
        *[F.coalesce(F.sum(share(s)), F.lit(0.0)).alias(f"sum_{s.name}") for s in signals],
        *[F.max(share(s)).alias(f"max_{s.name}") for s in signals],
    )
    total = sum((F.col(f"sum_{s.name}") for s in signals), F.lit(0.0))
    scored = sums.select(
        "entity_name",
        F.round(total / F.col("metric_signals") * 100, 2).alias("composite_reach_score"),
        "metric_signals",
        *[
            F.round(F.col(f"max_{s.name}") * 100, 2).alias(columns.get(s.name, s.name))
            for s in signals
        ],
    )
    return _top(
        scored,
        n,
        F.desc("composite_reach_score"),
        F.desc("metric_signals"),
        F.asc("entity_name"),
    )


def source_gap(
    facts: DataFrame, n: int | None = 25, signals: Sequence[Metric] = SIGNALS
) -> DataFrame:
    """Entities whose rank differs most between signals.

    One pass: an entity's ranks are gathered as numbers beside their extremes, and only the rows
    of the top list have them sorted and spelled out.
    """
    place = F.struct("signal", "signal_rank")
    per_entity = (
        rank_signals(metric_rows(facts, signals))
        .groupBy("entity_name")
        .agg(
            F.count("*").alias("signals_present"),
            F.min("signal_rank").alias("best_rank"),
            F.max("signal_rank").alias("worst_rank"),
            F.collect_list(place).alias("places"),
        )
        .where(F.col("signals_present") >= 2)
        .withColumn("rank_spread", F.col("worst_rank") - F.col("best_rank"))
    )
    shown = _top(
        per_entity, n, F.desc("rank_spread"), F.desc("signals_present"), F.asc("entity_name")
    )
    spelled = F.transform("places", lambda p: F.concat(p["signal"], F.lit("="), p["signal_rank"].cast("string")))
    return shown.select(
        "entity_name",
        "signals_present",
        "best_rank",
        "worst_rank",
        "rank_spread",
        F.sort_array(spelled).alias("rank_details"),
    )


def tag_reach(
    facts: DataFrame,
    n: int | None = 50,
    metrics: Sequence[tuple[Metric, int]] = TAG_METRICS,
    stop_tags: Iterable[str] = STOP_TAGS,
) -> DataFrame:
    """Mean metrics of the entities carrying a tag, for tags of two entities or more.

    An entity weighs as often as its sources name the tag. These repetitions
    are counted before the join, so one row per (entity, tag) is joined and
    averages come from exact weighted sums.
    """
    stop = [tag.lower() for tag in stop_tags]
    tag = F.col("tag")
    weights = (
        facts.where(F.col("tags").isNotNull())
        .select("entity_name", F.explode(F.split("tags", ",")).alias("tag"))
        .select("entity_name", F.trim(tag).alias("tag"))
        .where((tag != "") & ~F.lower(tag).isin(stop))
        .groupBy("entity_name", "tag")
        .agg(F.count("*").alias("weight"))
    )
    wide = pivot_metrics(facts, [m for m, _ in metrics])
    joined = weights.join(wide, "entity_name", "left")

    def mean(m: Metric, digits: int) -> Column:
        value = F.col(m.name)
        weighted = F.sum(value.cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)"))
        count = F.sum(F.when(value.isNotNull(), F.col("weight")))
        return F.round(weighted.cast("double") / count, digits).alias(f"avg_{m.name}")

    summary = (
        joined.groupBy("tag")
        .agg(
            F.count("entity_name").alias("entity_count"),
            *[mean(m, digits) for m, digits in metrics],
        )
        .where(F.col("entity_count") >= 2)
    )
    first = f"avg_{metrics[0][0].name}"
    return _top(summary, n, F.desc("entity_count"), F.desc_nulls_last(first), F.asc("tag"))


def metadata_coverage(
    facts: DataFrame,
    n: int | None = 50,
    sources: Sequence[str] = ENRICHMENT_SOURCES,
    tag_order: Sequence[str] = ENRICHMENT_TAG_ORDER,
) -> DataFrame:
    """Which enrichment sources know an entity, and the tags they give it."""
    wide = facts.groupBy("entity_name").agg(
        *[of_source(s, "entity_id").isNotNull().cast("int").alias(f"has_{s}_id") for s in sources],
        F.concat_ws(" | ", *[of_source(s, "tags") for s in tag_order]).alias("enrichment_tags"),
    )
    known = sum((F.col(f"has_{s}_id") for s in sources), F.lit(0))
    return _top(wide, n, F.desc(known), F.asc("entity_name"))


def entity_profile(
    facts: DataFrame, name: str, order: Sequence[str] = PROFILE_ORDER, exact: bool = False
) -> DataFrame:
    """All snapshots of one entity, sources in a fixed order.

    The name is matched without regard to case. With ``exact`` it is taken as
    the stored spelling, and the scan skips every row group that cannot hold it.
    """
    stored = F.col("entity_name")
    match = stored == name if exact else F.lower(stored) == F.lower(F.lit(name))
    place = F.lit(len(order) + 1)
    for position, source in reversed(list(enumerate(order, start=1))):
        place = F.when(F.col("source") == source, F.lit(position)).otherwise(place)
    return (
        facts.where(match)
        .select("entity_name", "source", "snapshot_date", "score", "reach", "volume", "tags")
        .orderBy(place, "source", "snapshot_date")
    )


def health_summary(facts: DataFrame) -> DataFrame:
    """Rows, entities and sources of a snapshot in one row.

    Rows and sources come from counts per source, entities from one distinct
    over the name alone, so no row is expanded for several distinct counts.
    """
    per_source = facts.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.max("snapshot_date").alias("newest")
    )
    entities = facts.agg(F.count_distinct("entity_name").alias("n")).scalar()
    return per_source.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("latest_snapshot_rows"),
        F.count("source").alias("enabled_sources"),
        F.sort_array(F.collect_list("source")).alias("sources_present"),
        F.max("newest").alias("latest_snapshot"),
    ).select(
        "latest_snapshot_rows",
        entities.alias("unique_entities"),
        "enabled_sources",
        "sources_present",
        "latest_snapshot",
    )


def all_queries(
    facts: DataFrame,
    sources: Iterable[str] | None,
    profile_of: str,
    as_of=None,
    whole: bool = False,
    latest: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Publish the view and return the whole suite by name; ``whole`` lists are not cut to their top.

    ``latest`` and ``profile`` are the parts of ``facts`` that the questions on the newest date and
    on one name look at, where the caller can read them for less than all.
    """
    top = {"n": None} if whole else {}
    kept = publish_view(facts, sources)
    newest = latest_snapshot(kept if latest is None else enabled_only(latest, sources), as_of)
    of_name = kept if profile is None else enabled_only(profile, sources)
    return {
        "scorecard": scorecard(newest, **top),
        "composite_reach": composite_reach(newest, **top),
        "source_gap": source_gap(newest, **top),
        "tag_reach": tag_reach(newest, **top),
        "metadata_coverage": metadata_coverage(newest, **top),
        "entity_profile": entity_profile(of_name, profile_of),
        "health_summary": health_summary(newest),
    }
