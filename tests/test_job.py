import datetime
import json
import re

import pytest

from renown.operators.checks import validation_report
from renown.operators.signals import metric_rows, metric_signals
from renown.plans import queries as q
from renown.plans.job import QualityGateError, run
from renown.model import FACT_SCHEMA, SIGNALS, SOURCES
from renown.sources import versions
from renown.sources.dims import entity_list
from renown.sources.quarantine import scan_quarantine
from renown.sources.raw import land_raw
from renown.sources.snapshots import replace_snapshots, scan_snapshots

DAY = "2026-04-26"
NAMES = ["Radiohead", "Tool", "Bjork"]


def record(source, name, i):
    """A complete record of a source under a spelling of its own."""
    spelled = {"lastfm": name.upper(), "wikimedia": name.replace("o", "ö")}.get(source, name)
    return {
        "source_artist_name": spelled,
        "id": f"{source}-{i}",
        "mbid": f"mb-{i}",
        "artist_mbid": f"mb-{i}",
        "idArtist": str(i),
        "artistId": i,
        "stats": {"listeners": str(100 + i), "playcount": 5000},
        "tags": {"tag": [{"name": "rock"}, {"name": "seen live"}]}
        if source == "lastfm"
        else [{"name": "rock", "count": 2}, {"name": "art", "count": 3}],
        "nb_fan": 200 - i,
        "rating": {"value": 4.5, "votes-count": 76},
        "total_listen_count": 300 + i,
        "listeners": ["u1", "u2"],
        "page_title": spelled,
        "latest_month_views": 10 + i,
        "total_window_views": 30 + i,
        "strGenre": "Rock",
        "primaryGenreName": "Alternative",
        "genre_labels": ["art rock"],
    }


def landed(spark, root, names=NAMES, extra=()):
    lines = [
        (spec.name, datetime.date.fromisoformat(DAY), json.dumps(record(spec.name, n, i)))
        for spec in SOURCES
        for i, n in enumerate(names)
    ]
    land_raw(
        spark.createDataFrame([*lines, *extra], "source string, snapshot_date date, payload string"),
        root,
    )


def folders(tmp_path):
    return {
        "store_root": str(tmp_path / "snapshots"),
        "raw_root": str(tmp_path / "raw"),
        "quarantine_root": str(tmp_path / "quarantine"),
    }


def test_full_run_then_queries_and_gate(spark, tmp_path):
    where = folders(tmp_path)
    broken = ("deezer", datetime.date.fromisoformat(DAY), '{"name": "cut')
    landed(spark, where["raw_root"], extra=[broken])
    entities = entity_list(spark, NAMES)
    done = run(spark, "full", entities=entities, profile_of="radiohead", snapshot_date=DAY, **where)

    facts = scan_snapshots(spark, where["store_root"])
    # Eight enabled sources, spotify stays out, every spelling is settled.
    assert facts.count() == 24
    assert {r.entity_name for r in facts.select("entity_name").collect()} == set(NAMES)
    quarantined = scan_quarantine(spark, where["quarantine_root"]).collect()
    assert [(r.source, r.record) for r in quarantined] == [("deezer", '{"name": "cut')]

    assert done.report.where("NOT passed").count() == 0
    assert done.queries["entity_profile"].count() == 8
    health = done.queries["health_summary"].first()
    assert (health.latest_snapshot_rows, health.unique_entities, health.enabled_sources) == (24, 3, 8)
    card = done.queries["scorecard"].first()
    assert (card.entity_name, card.lastfm_listeners, card.musicbrainz_rating) == ("Bjork", 102, 90)
    assert card.primary_tags == "rock, seen live"
    tags = {r.tag: r for r in done.queries["tag_reach"].collect()}
    assert "seen live" not in tags and tags["rock"].entity_count == 3
    assert tags["rock"].avg_lastfm_listeners == 101.0
    covered = done.queries["metadata_coverage"].first()
    assert covered.enrichment_tags == "Rock | art rock | Alternative"
    reach = {r.entity_name: r for r in done.queries["composite_reach"].collect()}
    # Bjork leads in three signals, ties in the rating and is last in fans.
    assert reach["Bjork"].composite_reach_score == 60.0 and reach["Bjork"].metric_signals == 5
    gap = done.queries["source_gap"].first()
    assert gap.rank_details == sorted(gap.rank_details) and gap.rank_spread == 2

    again = run(spark, "validate", entities=entities, profile_of="x", store_root=where["store_root"])
    assert again.queries == {}
    # A clean rerun of the same day keeps the facts and empties the quarantine.
    landed(spark, where["raw_root"])
    run(spark, "full", entities=entities, profile_of="x", snapshot_date=DAY, **where)
    assert scan_snapshots(spark, where["store_root"]).count() == 24
    assert scan_quarantine(spark, where["quarantine_root"]).count() == 0


def test_run_keeps_all_tags_whole_lists_and_blank_lines(spark, tmp_path):
    where = folders(tmp_path)
    day = datetime.date.fromisoformat(DAY)
    many = record("wikidata", "Extra", 70) | {"genre_labels": list("abcdefg")}
    names = [f"Name {i}" for i in range(60)]
    landed(spark, where["raw_root"], names, [("deezer", day, " "), ("wikidata", day, json.dumps(many))])
    entities = entity_list(spark, names)
    done = run(
        spark, "full", entities=entities, profile_of="x", snapshot_date=DAY, skip_validation=True, whole=True, **where
    )
    facts = scan_snapshots(spark, where["store_root"])
    assert facts.where("entity_name = 'Extra'").first().tags == "a, b, c, d, e, f, g"
    assert done.queries["composite_reach"].count() == 60
    quarantined = scan_quarantine(spark, where["quarantine_root"]).collect()
    assert [(r.source, r.reject_reason, r.record.strip()) for r in quarantined] == [("deezer", "malformed JSON", "")]


def test_gate_raises_unless_skipped(spark, tmp_path):
    where = folders(tmp_path)
    landed(spark, where["raw_root"])
    wider = entity_list(spark, [*NAMES, "Missing"])
    options = {"entities": wider, "profile_of": "Tool", "store_root": where["store_root"]}
    with pytest.raises(QualityGateError):
        run(spark, "full", snapshot_date=DAY, **{**where, **options})
    skipped = run(spark, "query", skip_validation=True, **options)
    assert skipped.report is None and skipped.queries["entity_profile"].count() == 8
    with pytest.raises(ValueError):
        run(spark, "stream", **options)


def test_gap_list_is_whole_for_duplicates_and_without_a_limit(spark):
    day = datetime.date.fromisoformat(DAY)
    rows = [
        (n, "1", s, day, 5, reach, 5, None)
        for n, s, reach in [
            ("a", "lastfm", 9), ("a", "lastfm", 8), ("a", "deezer", 1), ("a", "deezer", 1),
            ("b", "lastfm", 7), ("b", "deezer", 3), (None, "lastfm", 1), (None, "deezer", 9),
            ("c", "lastfm", 2),
        ]
    ]
    facts = spark.createDataFrame(rows, FACT_SCHEMA)
    top = q.source_gap(facts, n=2).collect()
    assert [(r.entity_name, r.rank_spread) for r in top] == [(None, 4), ("a", 2)]
    assert top[1].rank_details == [
        "deezer_fans=3", "deezer_fans=3", "lastfm_listeners=1", "lastfm_listeners=2",
    ]
    assert {r.entity_name: r.signals_present for r in q.source_gap(facts, n=None).collect()} == {
        None: 2, "a": 4, "b": 2,
    }
    assert metric_rows(facts, SIGNALS).count() == 9


def test_plans_prune_and_combine_early(spark, tmp_path):
    def plan(df):
        return df._jdf.queryExecution().toString()

    root = str(tmp_path / "snapshots")
    day = datetime.date.fromisoformat(DAY)
    replace_snapshots(
        spark.createDataFrame([("a", "1", "lastfm", day, 1, 1, 1, "x")], FACT_SCHEMA), root
    )
    facts = scan_snapshots(spark, root)
    profile = plan(q.entity_profile(facts, "a", exact=True))
    assert "EqualTo(entity_name,a)" in profile
    latest = facts.where(f"snapshot_date = DATE'{DAY}'")
    health = plan(q.health_summary(latest))
    assert "PartitionFilters: [isnotnull(snapshot_date" in health
    assert "ReadSchema: struct<source:string>" in health

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("] parquet")

    assert scans(metric_signals(latest)) == 1
    assert scans(validation_report(facts, entity_list(spark, ["a"]), as_of=DAY)) == 2
    reach = plan(q.composite_reach(latest))
    assert "Window.partitionBy" not in reach and "WindowGroupLimit" not in reach
    assert "ReadSchema: struct<entity_name:string,source:string,score:bigint,reach:bigint,volume:bigint>" in reach


def test_no_mode_scans_history(spark, tmp_path):
    """Every scan is cut to the newest date; only the profile looks back, by the stored key."""
    where = folders(tmp_path)
    landed(spark, where["raw_root"])
    entities = entity_list(spark, NAMES)
    older = datetime.date(2025, 1, 1)
    replace_snapshots(
        spark.createDataFrame([("Tool", "1", "lastfm", older, 1, 1, 1, "x")], FACT_SCHEMA), where["store_root"]
    )
    options = {"entities": entities, "profile_of": "tool", "store_root": where["store_root"]}
    modes = {
        "full": run(spark, "full", snapshot_date=DAY, **{**where, **options}),
        "query": run(spark, "query", **options),
        "validate": run(spark, "validate", **options),
    }

    def scans(df):
        plan = df._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
        return re.findall(r"FileScan parquet .*", plan)

    for outcome in modes.values():
        frames = {**outcome.queries, "report": outcome.report}
        profile = frames.pop("entity_profile", None)
        for df in frames.values():
            assert scans(df)
            for scan in scans(df):
                assert "PartitionFilters: [isnotnull(snapshot_date" in scan
                assert "InMemoryFileIndex(1 paths)" in scan
        if profile is not None:
            assert all("EqualTo(entity_key,tool)" in scan for scan in scans(profile))
            assert {r.snapshot_date for r in profile.collect()} == {older, datetime.date.fromisoformat(DAY)}


def test_the_gate_sees_columns_the_files_lack(spark, tmp_path):
    root = str(tmp_path / "store")
    version = versions.new_version()
    spark.range(1).selectExpr("'Tool' AS entity_name", "'lastfm' AS source").write.parquet(
        f"{versions.folder(root, version)}/snapshot_date={DAY}"
    )
    versions.publish(spark, root, [DAY], version)
    with pytest.raises(QualityGateError):
        run(spark, "validate", entities=entity_list(spark, ["Tool"]), profile_of="x", store_root=root)


def test_ingest_leaves_no_work_folder(spark, tmp_path, monkeypatch):
    where = folders(tmp_path)
    landed(spark, where["raw_root"])
    made = tmp_path / "work"
    monkeypatch.setattr("renown.sources.files.work_dir", lambda spark: str(made))
    run(spark, "full", entities=entity_list(spark, NAMES), profile_of="x", snapshot_date=DAY, **where)
    assert not made.exists()
