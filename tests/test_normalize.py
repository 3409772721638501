"""One hand-made record per trap."""

import datetime
import json

from renown.functions.tags import SHORT_LIST
from renown.operators.normalize import accepted, normalize_all, normalize_lines, normalize_source, rejected
from renown.sources.dims import entity_dim, entity_list
from renown.sources.raw import RAW_SOURCES, land_raw, of_source, parse_raw, raw_lines, raw_schema

DAY = "2026-04-26"


def raw(spark, source, *records):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return parse_raw(spark.createDataFrame([(line,) for line in lines], "payload string"), source)


def outcomes(spark, source, records, *columns, **options):
    """Per record, in order, the named fact columns or the reject reason; tag lists of five at most."""
    named = [{"name": "A B", **record} for record in records]
    options = {"max_tags": SHORT_LIST, **options}
    rows = normalize_source(raw(spark, source, *named).coalesce(1), source, DAY, **options).collect()
    return [r.reject_reason or tuple(r[c] for c in columns) for r in rows]


def check(spark, source, cases, *columns):
    records = [record for record, _ in cases]
    found = outcomes(spark, source, records, *columns)
    assert list(zip(records, found)) == cases


def values(spark, source, record, *columns):
    return outcomes(spark, source, [record], *columns)[0]


def test_counted(spark):
    cases = [
        ({"nb_fan": 5}, 5),
        ({"nb_fan": "5"}, 5),
        ({"nb_fan": 5.9}, 5),
        ({}, 0),
        ({"nb_fan": 3_000_000_000}, 3_000_000_000),
        ({"nb_fan": None}, "nb_fan: no count"),
        ({"nb_fan": ""}, "nb_fan: no count"),
        ({"nb_fan": "12.5"}, "nb_fan: no count"),
        ({"nb_fan": {"n": 1}}, "nb_fan: no count"),
    ]
    doubled = [(r, want if isinstance(want, str) else (want, want)) for r, want in cases]
    check(spark, "deezer", doubled, "reach", "score")


def test_spotify(spark):
    cases = [
        ({"id": "x", "followers": {"total": 3}, "popularity": "7"}, ("x", 7, 3)),
        ({"id": 399}, ("399", None, None)),
        ({"followers": {}, "popularity": ""}, ("", None, None)),
        ({"id": None, "followers": {"total": None}}, (None, None, None)),
        ({"followers": None}, "followers: no object"),
        ({"followers": "many"}, "followers: no object"),
        ({"popularity": "12.5"}, "popularity: no count"),
    ]
    check(spark, "spotify", cases, "entity_id", "score", "reach")


def test_tag_lists(spark):
    cases = [
        (["a", "", "b", "c", "d", "e"], "a, b, c, d"),
        ([{"name": "a"}, "b", {"x": 1}], "a, b"),
        (["", ""], None),
        ([], None),
        (None, None),
        ("plain", "plain"),
        ("", None),
    ]
    check(spark, "spotify", [({"genres": g}, (want,)) for g, want in cases], "tags")
    check(spark, "wikidata", [({"genre_labels": g}, (want,)) for g, want in cases], "tags")


def tag(*names):
    return {"tags": {"tag": [{"name": n} for n in names]}}


def test_lastfm(spark):
    cases = [
        ({"mbid": "m", "stats": {"listeners": "4", "playcount": 9}}, ("m", 4, 9, None)),
        ({"mbid": ""}, ("ab", 0, 0, None)),
        ({"mbid": None, "stats": {"playcount": 9}}, ("ab", 0, 9, None)),
        (tag("a", "", "c", "d", "e", "f"), ("ab", 0, 0, "a, , c, d, e")),
        ({"tags": {"tag": ""}}, ("ab", 0, 0, None)),
        ({"tags": {"tag": []}}, ("ab", 0, 0, None)),
        ({"tags": {}}, ("ab", 0, 0, None)),
        ({"stats": None}, "stats: no object"),
        ({"stats": {"listeners": None}}, "stats.listeners: no count"),
        ({"stats": {"playcount": ""}}, "stats.playcount: no count"),
        ({"tags": ""}, "tags: no object"),
        ({"tags": None}, "tags: no object"),
        ({"tags": {"tag": {"name": "a"}}}, "tags.tag: no list"),
        (tag("a", None), "tags.tag: tag without name"),
        ({"tags": {"tag": [{"url": "a"}]}}, "tags.tag: tag without name"),
    ]
    check(spark, "lastfm", cases, "entity_id", "reach", "volume", "tags")


def test_musicbrainz(spark):
    cases = [
        ({"rating": {"value": 4.55, "votes-count": 7}}, (91, 7, None)),
        ({"rating": {"value": "4.99", "votes-count": "7"}}, (99, 7, None)),
        ({"rating": {"value": None, "votes-count": None}}, (0, 0, None)),
        ({"rating": {"value": "", "votes-count": ""}}, (0, 0, None)),
        ({}, (0, 0, None)),
        (
            {"tags": [{"name": n, "count": c} for n, c in zip("abcdef", [1, 3, 3, 0, 9, 3])]},
            (0, 0, "e, b, c, f, a"),
        ),
        ({"tags": [{"name": "a"}, {"name": "b", "count": 1}]}, (0, 0, "b, a")),
        ({"tags": None}, (0, 0, None)),
        ({"tags": [{"name": "a", "count": None}]}, (0, 0, "a")),
        ({"tags": [{"name": "a", "count": None}, {"name": "b"}]}, "tags: null count"),
        ({"tags": [{"count": 1}]}, "tags: tag without name"),
        ({"tags": {"name": "a"}}, "tags: no list"),
        ({"rating": None}, "rating: no object"),
        ({"rating": {"value": "high"}}, "rating.value: no number"),
        ({"rating": {"votes-count": "1.5"}}, "rating.votes-count: no count"),
    ]
    check(spark, "musicbrainz", cases, "score", "reach", "tags")


def test_listenbrainz(spark):
    cases = [
        ({"total_listen_count": 5, "listeners": ["a", {"b": 1}]}, (5, 2, 5)),
        ({"total_listen_count": None, "listeners": []}, (None, None, None)),
        ({"total_listen_count": "", "listeners": None}, (None, None, None)),
        ({"total_listen_count": "5x"}, "total_listen_count: no count"),
    ]
    check(spark, "listenbrainz", cases, "score", "reach", "volume")


def test_wikimedia(spark):
    cases = [
        (
            {"page_title": "T", "latest_month_views": 2, "total_window_views": "9"},
            ("T", 2, 2, 9),
        ),
        ({}, ("A B", None, None, None)),
        ({"page_title": None, "latest_month_views": ""}, (None, None, None, None)),
        ({"total_window_views": "x"}, "total_window_views: no count"),
    ]
    check(spark, "wikimedia", cases, "entity_id", "score", "reach", "volume")


def test_metadata_sources(spark):
    audio = {"idArtist": "9", "strGenre": "Rock", "strStyle": ["Pop", "", "Rock"], "strMood": "Sad"}
    assert values(spark, "theaudiodb", audio, "entity_id", "tags") == ("9", "Rock, Pop, Sad")
    assert values(spark, "theaudiodb", {"strGenre": "", "strMood": None}, "tags") == (None,)
    assert values(spark, "itunes", {"artistId": 7}, "entity_id", "tags") == ("7", None)
    assert values(spark, "itunes", {"primaryGenreName": ""}, "entity_id", "tags") == ("", "")


def test_names_and_dates(spark):
    dim = entity_dim(entity_list(spark, ["Tool"]))
    records = [
        {"source_artist_name": "TOOL", "name": "x"},
        {"source_artist_name": "", "name": "tool"},
        {"name": None},
    ]
    done = normalize_source(raw(spark, "lastfm", *records), "lastfm", DAY, dim).collect()
    assert sorted((r.entity_name, r.entity_id) for r in done) == [
        ("Tool", "tool"),
        ("Tool", "tool"),
        ("Unknown", "unknown"),
    ]
    assert {r.snapshot_date for r in done} == {datetime.date(2026, 4, 26)}


def test_nothing_is_lost(spark):
    broken = '{"id": 1, "nb_fan"'
    by_source = {
        "deezer": raw(spark, "deezer", {"name": "a"}, broken, {"name": "b", "nb_fan": None}),
        "itunes": raw(spark, "itunes", {"name": "a"}, {"name": "a"}),
        "unheard_of": raw(spark, "itunes", {"name": "z"}),
    }
    done = normalize_all(by_source, DAY)
    good, bad = accepted(done).collect(), rejected(done).collect()
    assert sorted((r.source, r.entity_name) for r in good) == [
        ("deezer", "a"),
        ("itunes", "a"),
        ("itunes", "a"),
    ]
    assert {(r.reject_reason, r.record) for r in bad} == {
        ("malformed JSON", broken),
        ("nb_fan: no count", '{"name":"b","nb_fan":null}'),
    }


def test_text_that_is_no_record_is_rejected(spark):
    lines = ["null", "", "[1]", '"text"', '{"name": "a"} trailing', '{"name": "fine"}']
    done = normalize_source(raw(spark, "itunes", *lines), "itunes", DAY)
    assert [r.entity_name for r in accepted(done).collect()][-1] == "fine"
    bad = {r.record for r in rejected(done).collect()}
    assert {"null", "", "[1]", '"text"'} <= bad


def test_schemas_are_declared_for_all_sources():
    assert len(RAW_SOURCES) == 9
    assert all("source_artist_name" in raw_schema(s).fieldNames() for s in RAW_SOURCES)


def test_tag_lists_are_whole_by_default(spark):
    letters = list("abcdefgh")
    records = {
        "spotify": {"genres": letters},
        "wikidata": {"genre_labels": letters},
        "lastfm": {"tags": {"tag": [{"name": n} for n in letters]}},
        "musicbrainz": {"tags": [{"name": n, "count": 9 - k} for k, n in enumerate(letters)]},
    }
    for source, record in records.items():
        (row,) = normalize_source(raw(spark, source, {"name": "A", **record}), source, DAY).collect()
        assert row.tags == ", ".join(letters), source


def test_rejects_work_out_no_fact_and_facts_judge_once(spark):
    """The plan of the rejects has neither ids nor tags; that of the facts asks each reason once."""

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    mapped = normalize_all({s: raw(spark, s, "{}") for s in ("spotify", "wikidata", "lastfm")}, DAY)
    shown = plan(rejected(mapped))
    assert "AS tags" not in shown and "AS entity_id" not in shown and "_mbid" not in shown
    assert "array_join" not in shown
    assert plan(accepted(mapped)).count("followers: no object") == 1


ODD_LINES = [
    ("spotify", '{"name": "A", "id": "x", "followers": {"total": 3}, "genres": ["p", {"name": "q"}]}'),
    ("spotify", '{"name": "A", "followers": 5, "nb_fan": 7}'),
    ("lastfm", '{"name": "A", "stats": {"listeners": "9"}, "tags": {"tag": [{"name": "t"}, {"name": ""}]}}'),
    ("lastfm", '{"name": "A", "mbid": "m", "tags": [1]}'),
    ("deezer", '{"source_artist_name": "b", "name": "A", "id": 5, "nb_fan": "12"}'),
    ("deezer", '{"name": "A", "nb_fan": null}'),
    ("musicbrainz", '{"name": "A", "id": "i", "rating": {"value": 4.55}, "tags": [{"name": "x", "count": 1}, {"name": "y", "count": 3}]}'),
    ("musicbrainz", '{"name": "A", "rating": 1, "genres": ["not", "mine"]}'),
    ("listenbrainz", '{"name": "A", "artist_mbid": "m", "total_listen_count": 4, "listeners": [1, 2]}'),
    ("wikimedia", '{"name": "A", "latest_month_views": 2, "total_window_views": "x"}'),
    ("wikimedia", '{"name": "A", "latest_month_views": 2, "total_window_views": 5}'),
    ("theaudiodb", '{"name": "A", "idArtist": 3, "strGenre": "Rock", "strStyle": ["a", "Rock"]}'),
    ("itunes", '{"name": "A", "artistId": 3, "primaryGenreName": "Pop", "tags": "foreign"}'),
    ("wikidata", '{"name": "A", "id": "Q1", "genre_labels": ["u", "", "v"]}'),
    ("wikidata", '{"torn'),
    ("deezer", " "),
    ("deezer", "null"),
    ("itunes", "[1]"),
    ("itunes", None),
    ("unheard_of", '{"name": "A"}'),
]


def test_one_pass_over_lines_equals_source_by_source(spark):
    """Every source, good and bad records, fields of other sources among them; one scan of the lines."""
    lines = spark.createDataFrame(
        [(s, datetime.date.fromisoformat(DAY), p) for s, p in ODD_LINES] + [("itunes", datetime.date(2020, 1, 1), "{}")],
        "source string, snapshot_date date, payload string",
    )
    dim = entity_dim(entity_list(spark, ["A!", "B!"]))
    for options in ({}, {"max_tags": 1}):
        apart = normalize_all({s: of_source(lines, s, DAY) for s in RAW_SOURCES}, DAY, dim, **options)
        whole = normalize_lines(lines, DAY, dim, **options)
        assert whole.columns == apart.columns
        assert sorted(map(str, whole.collect())) == sorted(map(str, apart.collect()))
        assert whole.count() == len(ODD_LINES) - 1
        plan = whole._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("payload") and plan.count("Union") == 0
    some = normalize_lines(lines, DAY, dim, sources=["itunes", "deezer", "nobody"])
    assert {r.source for r in some.collect()} == {"itunes", "deezer"}
    assert normalize_lines(lines, DAY, dim, sources=[]).count() == 0


def test_landed_lines_are_scanned_once(spark, tmp_path):
    root = str(tmp_path / "raw")
    land_raw(
        spark.createDataFrame(
            [(s, datetime.date.fromisoformat(DAY), "{}") for s in RAW_SOURCES],
            "source string, snapshot_date date, payload string",
        ),
        root,
    )
    plan = normalize_lines(raw_lines(spark, root), DAY)._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    assert plan.count("FileScan text") == 1 and "snapshot_date" in plan.partition("PartitionFilters: [")[2].partition("]")[0]
