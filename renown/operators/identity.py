"""Whose record is this: names, ids and best matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.functions.names import canonical_key, non_blank

UNKNOWN = "Unknown"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark applies the limit of 1 before the shuffle as well (WindowGroupLimit),
    so a key with a third of all rows reaches the reducer as one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def canonicalize_names(
    df: DataFrame, dim: DataFrame | None, unknown: str | None = UNKNOWN
) -> DataFrame:
    """Replace ``entity_name`` by the configured spelling with the same key.

    Without a match the name stays; a null or empty name becomes ``unknown``,
    or stays as well when ``unknown`` is None. Spark broadcasts ``dim`` only when its
    size is below the session's threshold; a larger one is joined by shuffle,
    and the adaptive skew join splits a name that holds most of the rows.
    """
    own = F.col("entity_name")
    fallback = own if unknown is None else F.coalesce(non_blank(own), F.lit(unknown))
    if dim is None:
        return df.withColumn("entity_name", fallback)
    names = dim.select(
        F.col("entity_key").alias("_key"), F.col("entity_name").alias("_configured")
    )
    return (
        df.withColumn("_key", non_blank(canonical_key("entity_name")))
        .join(names, "_key", "left")
        .withColumn("entity_name", F.coalesce("_configured", fallback))
        .select(*df.columns)
    )


def priority_id_merge(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """One id per entity from two sources of (entity_name, entity_id, seq).

    The primary source beats the secondary one. Within the primary the last
    ``seq`` wins, within the secondary the first. Blank names and ids are ignored.
    """
    ranked = primary.select(
        "entity_name", "entity_id", F.lit(0).alias("priority"), (-F.col("seq")).alias("place")
    ).unionByName(
        secondary.select(
            "entity_name", "entity_id", F.lit(1).alias("priority"), F.col("seq").alias("place")
        )
    )
    usable = ranked.where(
        non_blank(F.col("entity_name")).isNotNull() & non_blank(F.col("entity_id")).isNotNull()
    )
    best = first_per_key(
        usable, ["entity_name"], [F.col("priority"), F.col("place"), F.col("entity_id")]
    )
    return best.select("entity_name", "entity_id", "priority")


def with_known_id(entities: DataFrame, ids: DataFrame) -> DataFrame:
    """Entities for which some id is known."""
    return entities.join(ids.select("entity_name"), "entity_name", "left_semi")


def title_lookup(entities: DataFrame, pages: DataFrame) -> DataFrame:
    """Page data under the override or the name, else under the searched title.

    ``entities`` has (entity_name, title_override, search_title); ``pages`` has
    one row per ``page_title``. Both candidate titles go through a single join,
    so the page table is shuffled once; entities without any page get no row.
    """
    configured = F.coalesce("title_override", "entity_name")
    searched = F.when(
        non_blank(F.col("search_title")).isNotNull() & (F.col("search_title") != configured),
        F.col("search_title"),
    )
    candidates = entities.select(
        "entity_name", F.posexplode(F.array(configured, searched)).alias("attempt", "page_title")
    ).where(F.col("page_title").isNotNull())
    found = candidates.join(pages, "page_title")
    return first_per_key(found, ["entity_name"], [F.col("attempt")]).select(
        "entity_name", "page_title", *[c for c in pages.columns if c != "page_title"]
    )


def detail_over_search(search: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """The detail record of a search hit where there is one, else the hit itself.

    The record is taken as a whole: a field the detail leaves empty stays empty.
    ``detail`` has one row per key and the columns of ``search``.
    """
    fields = [c for c in search.columns if c != key]
    packed = detail.select(key, F.struct(*fields).alias("_detail"))
    return (
        search.select(key, F.struct(*fields).alias("_hit"))
        .join(packed, key, "left")
        .select(key, F.coalesce("_detail", "_hit").alias("record"))
        .select(key, "record.*")
    )


def best_hit(hits: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first search result per entity; entities without results get no row."""
    return first_per_key(hits, keys, order)


def cache_misses(entities: DataFrame, cache: DataFrame) -> DataFrame:
    """Entities the cache does not know: the ones to look up."""
    return entities.join(cache.select("entity_name"), "entity_name", "left_anti")


def enrich_incrementally(entities: DataFrame, cache: DataFrame, lookups: DataFrame) -> DataFrame:
    """Cached records for known entities, new lookups for the rest.

    ``cache`` and ``lookups`` share their columns, one row per ``entity_name``.
    A miss without a lookup gives no row, so it is not cached either.
    """
    names = entities.select("entity_name")
    hits = cache.join(names, "entity_name", "left_semi")
    fresh = lookups.join(cache_misses(names, cache), "entity_name", "left_semi")
    return hits.withColumn("from_cache", F.lit(True)).unionByName(
        fresh.withColumn("from_cache", F.lit(False))
    )


def merged_cache(cache: DataFrame, enriched: DataFrame) -> DataFrame:
    """The cache for the next run: the old one plus what was looked up."""
    return cache.unionByName(enriched.where(~F.col("from_cache")).drop("from_cache"))
