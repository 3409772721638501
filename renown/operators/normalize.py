"""Raw records of nine sources to one fact table.

Every mapper says where the fact columns come from and which records it cannot read. Mapping
has two phases: a record is judged first, on the fields that its reasons look at, and facts
are a projection on top of the judged record. So a reader of the rejects works out no
fact, a reader of the facts works them out for good records alone, and each reason is
worked out once. Broken records stay in the output with a reason until ``accepted`` and
``rejected`` split them, so nothing fails and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.functions import variants as v
from renown.functions.names import non_blank
from renown.functions.tags import distinct_tags, first_names, first_of, join_or_null, tags_or_text
from renown.model import FACT_COLUMNS, FACT_SCHEMA
from renown.operators.identity import canonicalize_names
from renown.sources.raw import CORRUPT, parse_lines, raw_schema

# How an id left empty follows from the canonical name.
COMPACT_NAME = "compact"
SAME_NAME = "same"


@dataclass
class SourceMap:
    """Fact columns of one source; what is not named is null.

    ``parts`` are intermediate columns, stage by stage, each stage reading the ones before:
    values that a reason looks at. ``late`` are those that facts alone need. Values used
    more than once belong there, so that they are worked out once per record. No two sources
    share a part's name, as all sources may be mapped in one pass.
    """

    entity_id: Column
    score: Column | None = None
    reach: Column | None = None
    volume: Column | None = None
    tags: Column | None = None
    id_rule: Column = field(default_factory=lambda: F.lit(None).cast("string"))
    broken: Mapping[str, Column] = field(default_factory=dict)
    parts: Sequence[Mapping[str, Column]] = ()
    late: Sequence[Mapping[str, Column]] = ()


def _spotify(max_tags: int | None) -> SourceMap:
    followers = F.col("followers")
    score, bad_score = v.optional_count(F.col("popularity"))
    reach, bad_reach = v.optional_count(F.col("_spotify_total"))
    return SourceMap(
        parts=[{"_spotify_total": v.member(followers, "$.total")}],
        late=[
            {"_spotify_listed": v.items(F.col("genres"))},
            {"_spotify_names": first_names(F.col("_spotify_listed"), max_tags)},
        ],
        entity_id=v.identifier(F.col("id")),
        score=score,
        reach=reach,
        tags=tags_or_text(F.col("genres"), F.col("_spotify_listed"), F.col("_spotify_names")),
        broken={
            "followers: no object": v.not_an_object(followers),
            "followers.total: no count": bad_reach,
            "popularity: no count": bad_score,
        },
    )


def _lastfm(max_tags: int | None) -> SourceMap:
    stats, tags = F.col("stats"), F.col("tags")
    reach, bad_reach = v.counted(F.col("_lastfm_listeners"))
    volume, bad_volume = v.counted(F.col("_lastfm_playcount"))
    listed, names = F.col("_lastfm_listed"), F.col("_lastfm_names")
    no_id = F.coalesce(F.col("_lastfm_mbid"), F.lit("")) == ""
    return SourceMap(
        parts=[
            {
                "_lastfm_listeners": v.member(stats, "$.listeners"),
                "_lastfm_playcount": v.member(stats, "$.playcount"),
                "_lastfm_listed": v.records(tags, "name:string", "$.tag"),
            },
            {"_lastfm_names": first_of(listed, max_tags)["name"]},
        ],
        late=[{"_lastfm_mbid": v.text(F.col("mbid"))}],
        entity_id=F.col("_lastfm_mbid"),
        id_rule=F.when(no_id, F.lit(COMPACT_NAME)),
        score=reach,
        reach=reach,
        volume=volume,
        tags=join_or_null(names),
        broken={
            "stats: no object": v.not_an_object(stats),
            "stats.listeners: no count": bad_reach,
            "stats.playcount: no count": bad_volume,
            "tags: no object": v.not_an_object(tags),
            "tags.tag: no list": listed.isNull() & ~v.is_blank(v.member(tags, "$.tag")),
            "tags.tag: tag without name": F.exists(names, lambda name: name.isNull()),
        },
    )


def _deezer(max_tags: int | None) -> SourceMap:
    fans, bad_fans = v.counted(F.col("nb_fan"))
    return SourceMap(
        entity_id=v.identifier(F.col("id")),
        score=fans,
        reach=fans,
        broken={"nb_fan: no count": bad_fans},
    )


def _musicbrainz(max_tags: int | None) -> SourceMap:
    rating, tags = F.col("rating"), F.col("tags")
    listed, scaled = F.col("_musicbrainz_listed"), F.col("_musicbrainz_scaled")
    no_stars = v.is_blank(F.col("_musicbrainz_stars"))
    votes, bad_votes = v.count_or_zero(F.col("_musicbrainz_votes"))

    # Largest count first; the position breaks ties, so equal counts keep the
    # order of the source.
    def weighed(tag: Column, position: Column) -> Column:
        weight = -F.coalesce(v.whole(tag["count"]), F.lit(0))
        return F.struct(weight, position, tag["name"].alias("name"))

    best = first_of(F.sort_array(F.transform(listed, weighed)), max_tags)
    names = F.col("_musicbrainz_best.name")
    # All tags count unless a limit cuts the sorted list; then only those before the cut are asked.
    sorting = {"_musicbrainz_best": best}
    judged_names = listed["name"] if max_tags is None else names
    null_count = F.exists(listed, lambda tag: F.is_variant_null(tag["count"]))
    return SourceMap(
        parts=[
            {
                "_musicbrainz_stars": v.member(rating, "$.value"),
                "_musicbrainz_votes": v.member(rating, "$['votes-count']"),
                "_musicbrainz_listed": v.records(tags, "name:string,count:variant"),
            },
            {
                "_musicbrainz_scaled": (F.try_variant_get("_musicbrainz_stars", "$", "double") * 20).try_cast("bigint"),
                **({} if max_tags is None else sorting),
            },
        ],
        late=[sorting] if max_tags is None else [],
        entity_id=v.identifier(F.col("id")),
        score=F.when(no_stars, F.lit(0)).otherwise(scaled),
        reach=votes,
        tags=join_or_null(names),
        broken={
            "rating: no object": v.not_an_object(rating),
            "rating.value: no number": scaled.isNull() & ~no_stars,
            "rating.votes-count: no count": bad_votes,
            "tags: no list": listed.isNull() & ~v.is_blank(tags),
            "tags: null count": (F.array_size(listed) > 1) & null_count,
            "tags: tag without name": F.exists(judged_names, lambda name: name.isNull()),
        },
    )


def _listenbrainz(max_tags: int | None) -> SourceMap:
    listens, bad_listens = v.optional_count(F.col("total_listen_count"))
    return SourceMap(
        entity_id=v.identifier(F.col("artist_mbid")),
        score=listens,
        reach=F.nullif(F.array_size(v.items(F.col("listeners"))), F.lit(0)),
        volume=listens,
        broken={"total_listen_count: no count": bad_listens},
    )


def _wikimedia(max_tags: int | None) -> SourceMap:
    month, bad_month = v.optional_count(F.col("latest_month_views"))
    window, bad_window = v.optional_count(F.col("total_window_views"))
    title = F.col("page_title")
    return SourceMap(
        entity_id=v.text(title),
        id_rule=F.when(title.isNull(), F.lit(SAME_NAME)),
        score=month,
        reach=month,
        volume=window,
        broken={
            "latest_month_views: no count": bad_month,
            "total_window_views: no count": bad_window,
        },
    )


def _theaudiodb(max_tags: int | None) -> SourceMap:
    return SourceMap(
        entity_id=v.identifier(F.col("idArtist")),
        tags=distinct_tags(F.col("strGenre"), F.col("strStyle"), F.col("strMood")),
    )


def _itunes(max_tags: int | None) -> SourceMap:
    return SourceMap(entity_id=v.identifier(F.col("artistId")), tags=F.col("primaryGenreName"))


def _wikidata(max_tags: int | None) -> SourceMap:
    labels = F.col("genre_labels")
    return SourceMap(
        late=[
            {"_wikidata_listed": v.items(labels)},
            {"_wikidata_names": first_names(F.col("_wikidata_listed"), max_tags)},
        ],
        entity_id=v.identifier(F.col("id")),
        tags=tags_or_text(labels, F.col("_wikidata_listed"), F.col("_wikidata_names")),
    )


MAPPERS = {
    "spotify": _spotify,
    "lastfm": _lastfm,
    "deezer": _deezer,
    "musicbrainz": _musicbrainz,
    "listenbrainz": _listenbrainz,
    "wikimedia": _wikimedia,
    "theaudiodb": _theaudiodb,
    "itunes": _itunes,
    "wikidata": _wikidata,
}


def _judged(staged: DataFrame, reason: Column) -> DataFrame:
    """The columns so far and ``reject_reason``.

    ``inline`` holds the row as worked out here. A later filter on the reason would otherwise be
    pushed below and work out the reason a second time.
    """
    return staged.select(F.inline(F.array(F.struct(*staged.columns, reason.alias("reject_reason")))))


def _reason(mapping: SourceMap) -> Column:
    return F.coalesce(
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed JSON")),
        *[F.when(bad, F.lit(reason)) for reason, bad in mapping.broken.items()],
    )


def _known(mapping: SourceMap, record_fields: Sequence[str]) -> dict[str, Column]:
    """Fact columns of one source that are not the same for all, the rule of its ids, and the text of a rejected record."""
    none = F.lit(None)
    return {
        "entity_id": mapping.entity_id,
        "score": none if mapping.score is None else mapping.score,
        "reach": none if mapping.reach is None else mapping.reach,
        "volume": none if mapping.volume is None else mapping.volume,
        "tags": none if mapping.tags is None else mapping.tags,
        "id_rule": mapping.id_rule,
        "record": F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*record_fields))),
    }


def _facts(judged: DataFrame, source: Column, snapshot_date, known: Mapping[str, Column]) -> DataFrame:
    """Fact columns, ``id_rule``, ``reject_reason`` and ``record``."""
    common = {
        "entity_name": F.coalesce(non_blank(F.col("source_artist_name")), F.col("name")),
        "source": source,
        "snapshot_date": F.lit(snapshot_date),
    }
    columns = [{**known, **common}[f.name].cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields]
    record = F.when(F.col("reject_reason").isNotNull(), known["record"])
    return judged.select(*columns, known["id_rule"].alias("id_rule"), "reject_reason", record.alias("record"))


def _map(raw: DataFrame, source: str, snapshot_date, max_tags: int | None) -> DataFrame:
    """The records of one source."""
    mapping = MAPPERS[source](max_tags)
    staged = raw
    for part in mapping.parts:
        staged = staged.withColumns(dict(part))
    judged = _judged(staged, _reason(mapping))
    for part in mapping.late:
        judged = judged.withColumns(dict(part))
    fields = [c for c in raw.columns if c != CORRUPT]
    return _facts(judged, F.lit(source), snapshot_date, _known(mapping, fields))


def _map_lines(parsed: DataFrame, sources: Sequence[str], snapshot_date, max_tags: int | None) -> DataFrame:
    """The records of many sources, told apart by ``source``, in one pass."""
    mappings = {s: MAPPERS[s](max_tags) for s in sources}

    def chosen(columns: Mapping[str, Column]) -> Column:
        cases = F
        for source, column in columns.items():
            cases = cases.when(F.col("source") == source, column)
        return cases

    def staged(df: DataFrame, stages: str) -> DataFrame:
        """Part by part; what belongs to another source is null and costs nothing."""
        for depth in range(max(len(getattr(m, stages)) for m in mappings.values())):
            columns = {
                name: F.when(F.col("source") == s, column)
                for s, m in mappings.items()
                for name, column in (getattr(m, stages)[depth].items() if depth < len(getattr(m, stages)) else ())
            }
            df = df.withColumns(columns)
        return df

    judged = _judged(staged(parsed, "parts"), chosen({s: _reason(m) for s, m in mappings.items()}))
    judged = staged(judged, "late")
    known = {s: _known(m, raw_schema(s).fieldNames()[:-1]) for s, m in mappings.items()}
    columns = {name: chosen({s: k[name] for s, k in known.items()}) for name in next(iter(known.values()))}
    return _facts(judged, F.col("source"), snapshot_date, columns)


def normalize_all(
    raw_by_source: Mapping[str, DataFrame],
    snapshot_date,
    dim: DataFrame | None = None,
    max_tags: int | None = None,
) -> DataFrame:
    """Map every known source, union by name, then settle names and ids once.

    Unknown sources are ignored and duplicates kept. Lists of tags are whole, or end after ``max_tags``. The result has the fact
    columns plus ``reject_reason`` and ``record``, the raw text of a rejected row.
    """
    mapped = [
        _map(raw, source, snapshot_date, max_tags)
        for source, raw in raw_by_source.items()
        if source in MAPPERS
    ]
    if not mapped:
        known = next(iter(raw_by_source.values()), dim)
        if known is None:
            raise ValueError("no sources and no entity list to take a session from")
        none = known.sparkSession.createDataFrame([], FACT_SCHEMA)
        text = F.lit(None).cast("string")
        return none.select(*FACT_COLUMNS, text.alias("reject_reason"), text.alias("record"))
    return _settled(reduce(DataFrame.unionByName, mapped), dim)


def _settled(mapped: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Canonical names, and the ids that follow from them."""
    named = canonicalize_names(mapped, dim)
    compact = F.replace(F.lower("entity_name"), F.lit(" "), F.lit(""))
    settled_id = (
        F.when(F.col("id_rule") == COMPACT_NAME, compact)
        .when(F.col("id_rule") == SAME_NAME, F.col("entity_name"))
        .otherwise(F.col("entity_id"))
    )
    return named.withColumn("entity_id", settled_id).select(
        *FACT_COLUMNS, "reject_reason", "record"
    )


def normalize_lines(
    lines: DataFrame,
    snapshot_date,
    dim: DataFrame | None = None,
    max_tags: int | None = None,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """``normalize_all`` for landed lines (source, snapshot_date, payload) of one date, in a single scan.

    A line is parsed once, under the fields of all sources, and every fact column is a choice by source,
    so the plan holds one scan and one projection however many sources there are. Lines of sources
    that are unknown, or not among ``sources``, are left out; the filter prunes their folders.
    """
    wanted = [s for s in MAPPERS if sources is None or s in sources]
    day = F.col("snapshot_date") == F.lit(snapshot_date).cast("date")
    parsed = parse_lines(lines.where(F.col("source").isin(wanted) & day))
    if not wanted:
        none = F.lit(None).cast("string")
        empty = parsed.sparkSession.createDataFrame([], FACT_SCHEMA)
        return empty.select(*FACT_COLUMNS, none.alias("reject_reason"), none.alias("record"))
    return _settled(_map_lines(parsed, wanted, snapshot_date, max_tags), dim)


def normalize_source(
    raw: DataFrame,
    source: str,
    snapshot_date,
    dim: DataFrame | None = None,
    max_tags: int | None = None,
) -> DataFrame:
    """``normalize_all`` for one source."""
    return normalize_all({source: raw}, snapshot_date, dim, max_tags)


def accepted(normalized: DataFrame) -> DataFrame:
    """The fact rows."""
    return normalized.where(F.col("reject_reason").isNull()).select(*FACT_COLUMNS)


def rejected(normalized: DataFrame) -> DataFrame:
    """The records no fact row could be made of, with the reason."""
    return normalized.where(F.col("reject_reason").isNotNull()).select(
        "source", "snapshot_date", "reject_reason", "record"
    )
