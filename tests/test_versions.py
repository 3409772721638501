"""Replacement by version and pointer: what fails where, and what readers see."""

import datetime
from datetime import timedelta

import pytest

from renown.model import FACT_SCHEMA
from renown.operators.checks import absent_columns, missing_columns_report
from renown.plans.job import ingest_snapshot
from renown.sources import files, versions
from renown.sources.cache import cache_round, enrich_and_remember, load_cache, remember, vacuum_cache
from renown.sources.dims import entity_dim, entity_list
from renown.sources.quarantine import scan_quarantine
from renown.sources.raw import land_raw
from renown.sources.snapshots import (
    empty_facts,
    newest_date,
    replace_snapshots,
    scan_entity,
    scan_snapshots,
    snapshot_dates,
    stored_columns,
    stored_dates,
    vacuum_snapshots,
)

MONDAY, TUESDAY = datetime.date(2026, 4, 20), datetime.date(2026, 4, 21)
NOW = timedelta(0)


def facts(spark, *rows):
    """Rows of (name, source, date, score)."""
    return spark.createDataFrame([(n, "id", s, d, score, None, None, None) for n, s, d, score in rows], FACT_SCHEMA)


def stored(spark, root, **options):
    return sorted((r.entity_name, r.snapshot_date, r.score) for r in scan_snapshots(spark, root, **options).collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


@pytest.fixture
def two_days(spark, root):
    rows = [("a", "x", MONDAY, 1), ("b", "x", TUESDAY, 2), ("c", "y", TUESDAY, 3)]
    replace_snapshots(facts(spark, *rows), root)
    return stored(spark, root)


@pytest.fixture(params=["true", "false"], ids=["adaptive", "fixed"])
def adaptive(spark, request):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("only_date", [TUESDAY, None])
def test_a_failure_in_the_write_stage_keeps_the_day(spark, root, two_days, adaptive, only_date, monkeypatch):
    """The error is raised behind the last shuffle, in the tasks that write."""
    frame = type(spark.range(1))
    sort = frame.sortWithinPartitions

    def poisoned(self, *columns):
        held = sort(self, *columns)
        return held.selectExpr(
            *[c for c in held.columns if c != "tags"], "IF(score > 0, raise_error('lost'), tags) AS tags"
        )

    monkeypatch.setattr(frame, "sortWithinPartitions", poisoned)
    with pytest.raises(Exception, match="lost"):
        replace_snapshots(facts(spark, ("z", "x", TUESDAY, 9)), root, only_date)
    monkeypatch.undo()
    assert stored(spark, root) == two_days
    replace_snapshots(facts(spark, ("z", "x", TUESDAY, 9)), root, only_date)
    assert stored(spark, root) == [two_days[0], ("z", TUESDAY, 9)]


def test_a_failure_in_the_input_keeps_the_day(spark, root, two_days, adaptive):
    broken = facts(spark, ("z", "x", TUESDAY, 9)).selectExpr(
        *[f.name for f in FACT_SCHEMA if f.name != "tags"], "raise_error('lost') AS tags"
    )
    with pytest.raises(Exception, match="lost"):
        replace_snapshots(broken, root, TUESDAY)
    assert stored(spark, root) == two_days


def test_a_crash_before_the_pointer_moves_keeps_the_day(spark, root, two_days, monkeypatch):
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        replace_snapshots(facts(spark, ("z", "x", TUESDAY, 9)), root, TUESDAY)
    assert stored(spark, root) == two_days


def test_the_store_feeds_its_own_rerun(spark, root, two_days, adaptive):
    replace_snapshots(scan_snapshots(spark, root, [TUESDAY]).where("source = 'x'"), root, TUESDAY)
    assert stored(spark, root) == two_days[:2]
    replace_snapshots(scan_snapshots(spark, root), root)
    assert stored(spark, root) == two_days[:2]


def test_a_reader_keeps_what_it_began_with(spark, root, two_days):
    before = scan_snapshots(spark, root)
    replace_snapshots(facts(spark, ("z", "x", TUESDAY, 9)), root)
    assert before.count() == 3 and scan_snapshots(spark, root).count() == 2


def test_an_empty_day_is_stored_and_passed_over(spark, root, two_days):
    replace_snapshots(empty_facts(spark), root, TUESDAY)
    assert stored(spark, root) == two_days[:1]
    assert stored_dates(spark, root) == [TUESDAY, MONDAY]
    assert newest_date(spark, root) == MONDAY
    assert newest_date(spark, root, ["y"]) is None
    listed = sorted((r.snapshot_date, r.replacements) for r in snapshot_dates(spark, root).collect())
    assert listed == [(MONDAY, 1), (TUESDAY, 2)]


def test_newest_date_needs_an_enabled_source(spark, root, two_days):
    assert newest_date(spark, root) == TUESDAY
    replace_snapshots(facts(spark, ("c", "y", TUESDAY, 3)), root)
    assert newest_date(spark, root, ["x"]) == MONDAY


def test_nothing_stored(spark, root, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_snapshots(spark, root)
    assert newest_date(spark, root) is None
    replace_snapshots(empty_facts(spark), root)
    assert scan_snapshots(spark, root).count() == 0 and stored_dates(spark, root) == []


def test_only_asked_dates_are_read(spark, root, two_days):
    assert stored(spark, root, dates=[MONDAY]) == two_days[:1]
    assert stored(spark, root, dates=["2026-04-21"]) == two_days[1:]
    assert stored(spark, root, dates=[]) == []


def test_vacuum(spark, root, two_days):
    """Replaced dates go, also out of a version that still holds another date; what is in force stays."""
    replace_snapshots(facts(spark, ("z", "x", TUESDAY, 9)), root)
    replace_snapshots(facts(spark, ("z", "x", TUESDAY, 8)), root, TUESDAY)
    wanted = [two_days[0], ("z", TUESDAY, 8)]
    assert vacuum_snapshots(spark, root) == []  # all too young
    gone = vacuum_snapshots(spark, root, NOW - timedelta(minutes=1))
    assert len(gone) == 4  # two pointers, one date of the first version, the second version
    assert stored(spark, root) == wanted
    kept = [n for n in files.names(spark, root) if n.startswith("v=")]
    assert len(kept) == 2
    assert vacuum_snapshots(spark, root, NOW - timedelta(minutes=1)) == []
    replace_snapshots(facts(spark, ("z", "x", TUESDAY, 7)), root, TUESDAY)
    assert stored(spark, root) == [two_days[0], ("z", TUESDAY, 7)]


def test_of_two_writers_the_later_name_counts(spark, root, two_days):
    a, b = versions.Pointer("2026-04-21", 2, "a"), versions.Pointer("2026-04-21", 2, "b")
    for pointer in (b, a):
        files.create(spark, f"{root}/_current/{pointer.name}")
    assert versions.current(spark, root)["2026-04-21"] == b


def test_profile_by_stored_key(spark, root):
    rows = [("Björk", "x", MONDAY, 1), ("BJORK!", "x", TUESDAY, 2), ("Blur", "x", TUESDAY, 3), ("東京", "x", MONDAY, 4), (None, "x", MONDAY, 5)]
    replace_snapshots(facts(spark, *rows), root)
    found = scan_entity(spark, root, "bjork")
    assert sorted(r.score for r in found.collect()) == [1, 2]
    assert "EqualTo(entity_key,bjork)" in found._jdf.queryExecution().toString()
    # names without a key share the empty one and are told apart by the profile itself
    assert sorted(r.score for r in scan_entity(spark, root, "東京").collect()) == [4, 5]


def test_files_skip_other_keys(spark, root):
    """All rows of a name lie together, and the files carry a bloom filter of the keys."""
    import glob

    import pyarrow.parquet as pq

    many = spark.range(40_000).selectExpr(
        "concat('Name ', id) AS entity_name", "'1' AS entity_id", "'x' AS source", "DATE'2026-04-20' AS snapshot_date",
        "id AS score", "id AS reach", "id AS volume", "'t' AS tags",
    )
    replace_snapshots(many, root)
    paths = glob.glob(f"{root}/v=*/snapshot_date=2026-04-20/*.parquet")
    for path in paths:
        keys = pq.read_table(path, columns=["entity_key"])["entity_key"].to_pylist()
        assert keys == sorted(keys)
    assert sum(len(pq.read_table(p)) for p in paths) == 40_000
    assert [r.score for r in scan_entity(spark, root, "NAME 77").collect()] == [77]


def test_quarantine_follows_the_day(spark, tmp_path, monkeypatch):
    """A write of facts that fails leaves facts and quarantine of the day as they were."""
    raw, store, bad = (str(tmp_path / n) for n in ("raw", "store", "bad"))
    dim = entity_dim(entity_list(spark, ["Tool"]))

    def land(*lines):
        land_raw(spark.createDataFrame([("itunes", MONDAY, x) for x in lines], "source string, snapshot_date date, payload string"), raw)
        ingest_snapshot(spark, raw, store, bad, MONDAY, dim)

    land('{"name": "Tool", "artistId": 1}', "torn {")
    assert [r.record for r in scan_quarantine(spark, bad).collect()] == ["torn {"]
    with monkeypatch.context() as patch:
        patch.setattr("renown.plans.job.write_version", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            land('{"name": "Other"}')
    assert [r.record for r in scan_quarantine(spark, bad).collect()] == ["torn {"]
    assert [r.entity_name for r in scan_snapshots(spark, store).collect()] == ["Tool"]
    land('{"name": "Blur"}')
    assert scan_quarantine(spark, bad).count() == 0 and scan_quarantine(spark, bad, [MONDAY]).count() == 0
    assert [r.entity_name for r in scan_snapshots(spark, store).collect()] == ["Blur"]


def test_stored_columns_tell_what_files_lack(spark, root, two_days):
    version = versions.new_version()
    old = facts(spark, ("z", "x", TUESDAY, 9)).selectExpr("entity_name", "entity_id", "source", "CAST(score AS int) AS score")
    old.write.parquet(f"{versions.folder(root, version)}/snapshot_date={TUESDAY}")
    versions.publish(spark, root, [str(TUESDAY)], version)
    held = stored_columns(spark, root)
    assert absent_columns(held) == ["reach", "tags", "volume"]
    assert absent_columns(stored_columns(spark, root, [MONDAY])) == []
    report = missing_columns_report(held).where("NOT passed").collect()
    assert sorted((r.snapshot_date, r.column, r.stored_type) for r in report if r.stored_type) == [(TUESDAY, "score", "int")]
    assert {r.snapshot_date for r in report} == {TUESDAY} and len(report) == 4
    assert stored(spark, root)[-1] == ("z", TUESDAY, 9)


# --- cache -------------------------------------------------------------------

RECORD = "entity_name string, record string, n long"


def test_cache_over_three_rounds(spark, root):
    asked = []

    def look_up(missing):
        keys = sorted(r.entity_name for r in missing.collect())
        asked.append(keys)
        rows = [(k, f"r{len(asked)}", 1) for k in keys if k != "unknown"] + [("uninvited", "x", 1)]
        return spark.createDataFrame(rows, RECORD)

    def ask(*names):
        entities = spark.createDataFrame([(n,) for n in names], "entity_name string")
        return sorted(map(tuple, enrich_and_remember(entities, root, look_up, RECORD).collect()), key=str)

    assert load_cache(spark, root, RECORD).count() == 0 and cache_round(spark, root) == 0
    assert ask("a", "b", "unknown", None, "a") == [("a", "r1", 1, False), ("b", "r1", 1, False)]
    assert ask("b", "c", "unknown") == [("b", "r1", 1, True), ("c", "r2", 1, False)]
    # a miss without a record is asked for again, what nobody asked for is not kept
    assert asked == [["a", "b", "unknown"], ["c", "unknown"]]
    assert ask() == [] and cache_round(spark, root) == 3
    assert {r.entity_name: r.cache_round for r in load_cache(spark, root, RECORD).collect()} == {"a": 1, "b": 1, "c": 2}


def test_the_last_writer_wins_and_old_versions_go(spark, root):
    def rows(*r):
        return spark.createDataFrame(list(r), RECORD)

    remember(rows(("a", "one", 1), ("b", "one", 1), (None, "one", 1)), root)
    remember(rows(("b", "two", 9), ("b", "two", 3)), root)
    wanted = {"a": ("one", 1, 1), "b": ("two", 3, 2)}
    assert {r.entity_name: (r.record, r.n, r.cache_round) for r in load_cache(spark, root, RECORD).collect()} == wanted
    assert vacuum_cache(spark, root) == []
    assert len(vacuum_cache(spark, root, NOW - timedelta(minutes=1))) == 2
    assert load_cache(spark, root, RECORD).count() == 2


def test_a_failed_merge_leaves_the_cache(spark, root):
    remember(spark.createDataFrame([("a", "one", 1)], RECORD), root)
    broken = spark.createDataFrame([("b", "two", 2)], RECORD).selectExpr(
        "entity_name", "raise_error('lost') AS record", "n"
    ).selectExpr("entity_name", "CAST(record AS string) AS record", "n")
    with pytest.raises(Exception, match="lost"):
        remember(broken, root)
    assert [r.record for r in load_cache(spark, root, RECORD).collect()] == ["one"]


def test_unreadable_files_count_as_unknown(spark, root):
    remember(spark.createDataFrame([("a", "one", 1)], RECORD), root)
    live = versions.folder(root, versions.current(spark, root)["cache"].version)
    files.create(spark, f"{live}/part-torn.parquet", b"PAR1 torn")
    assert [r.record for r in load_cache(spark, root, RECORD).collect()] == ["one"]
    for name in files.names(spark, live):
        files.delete(spark, f"{live}/{name}")
    assert load_cache(spark, root, RECORD).count() == 0
