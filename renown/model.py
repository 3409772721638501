"""The fact table and the settings every operator takes as parameters.

One fact row says how visible one entity is in one source on one snapshot
date. ``score`` is the source's own popularity figure, ``reach`` counts people
(listeners, fans, views, votes) and ``volume`` counts plays or listens. A
source fills what it has; the rest is null. ``tags`` is ``", "``-joined text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType(
    [
        T.StructField("entity_name", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("score", T.LongType()),
        T.StructField("reach", T.LongType()),
        T.StructField("volume", T.LongType()),
        T.StructField("tags", T.StringType()),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()


@dataclass(frozen=True)
class Metric:
    """One fact column of one source, published under its own name."""

    name: str
    source: str
    column: str


@dataclass(frozen=True)
class SourceSpec:
    """What the validation gate and the source filter know about a source."""

    name: str
    enabled: bool = True
    required: bool = False
    min_coverage: float | None = None
    max_score: int | None = None


# The source registry. ``required`` sources must be present and
# carry a score; ``min_coverage`` is the least share of expected entities.
SOURCES = (
    SourceSpec("spotify", enabled=False),
    SourceSpec("lastfm", required=True, min_coverage=0.95),
    SourceSpec("deezer", required=True, min_coverage=0.90),
    SourceSpec("musicbrainz", required=True, min_coverage=0.75, max_score=100),
    SourceSpec("listenbrainz"),
    SourceSpec("wikimedia", required=True, min_coverage=0.75),
    SourceSpec("theaudiodb", min_coverage=0.40),
    SourceSpec("itunes", min_coverage=0.50),
    SourceSpec("wikidata", min_coverage=0.50),
)
MIN_SOURCE_COUNT = 6
DEFAULT_METRIC_COVERAGE = 0.95

# The signals that rank entities against each other.
SIGNALS = (
    Metric("lastfm_listeners", "lastfm", "reach"),
    Metric("deezer_fans", "deezer", "reach"),
    Metric("wikimedia_views", "wikimedia", "reach"),
    Metric("listenbrainz_listens", "listenbrainz", "volume"),
    Metric("musicbrainz_rating", "musicbrainz", "score"),
)

# The columns of the scorecard, the first three of SORT decide
# its order.
SCORECARD = (
    Metric("lastfm_listeners", "lastfm", "reach"),
    Metric("lastfm_playcount", "lastfm", "volume"),
    Metric("deezer_fans", "deezer", "reach"),
    Metric("wikipedia_monthly_views", "wikimedia", "reach"),
    Metric("listenbrainz_listens", "listenbrainz", "volume"),
    Metric("musicbrainz_rating", "musicbrainz", "score"),
)
SCORECARD_SORT = ("lastfm_listeners", "deezer_fans", "wikipedia_monthly_views")

# Where an entity's tags come from, best source first.
TAG_PRIORITY = ("lastfm", "musicbrainz", "wikidata", "theaudiodb", "itunes")

# The averages of the tag summary and their decimals.
TAG_METRICS = (
    (Metric("lastfm_listeners", "lastfm", "reach"), 0),
    (Metric("deezer_fans", "deezer", "reach"), 0),
    (Metric("wikipedia_views", "wikimedia", "reach"), 0),
    (Metric("listenbrainz_listens", "listenbrainz", "volume"), 0),
    (Metric("musicbrainz_rating", "musicbrainz", "score"), 1),
)
STOP_TAGS = ("seen live",)

# The short names of the percentile columns.
PERCENTILE_COLUMNS = {
    "lastfm_listeners": "lastfm_percentile",
    "deezer_fans": "deezer_percentile",
    "wikimedia_views": "wikipedia_percentile",
    "listenbrainz_listens": "listenbrainz_percentile",
    "musicbrainz_rating": "musicbrainz_percentile",
}

# Sources that only enrich, in column order and in tag order.
ENRICHMENT_SOURCES = ("itunes", "wikidata", "theaudiodb")
ENRICHMENT_TAG_ORDER = ("theaudiodb", "wikidata", "itunes")

# Row order of an entity profile; other sources follow by name.
PROFILE_ORDER = ("lastfm", "deezer", "wikimedia", "listenbrainz", "musicbrainz")

# Page titles that differ from the entity's name.
TITLE_OVERRIDES = {
    "Ado": "Ado (singer)",
    "Bjork": "Björk",
    "Blur": "Blur (band)",
    "Ghost": "Ghost (Swedish band)",
    "Gojira": "Gojira (band)",
    "Laufey": "Laufey (singer)",
    "MF DOOM": "MF Doom",
    "PornoGraffitti": "Porno Graffitti",
    "Sigur Ros": "Sigur Rós",
    "Tool": "Tool (band)",
    "Tyler the Creator": "Tyler, the Creator",
}

# The column names of the published SQL view.
VIEW_COLUMNS = {
    "entity_name": "artist_name",
    "entity_id": "artist_id",
    "source": "platform",
    "snapshot_date": "snapshot_date",
    "score": "popularity_score",
    "reach": "listeners",
    "volume": "playcount",
    "tags": "genres",
}


def enabled_sources(specs=SOURCES) -> list[str]:
    """Names of the sources switched on."""
    return [spec.name for spec in specs if spec.enabled]
