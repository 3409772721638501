import datetime
import time

import pytest

from renown.model import FACT_COLUMNS, FACT_SCHEMA, enabled_sources
from renown.operators.snapshot import enabled_only, latest_snapshot, publish_view
from renown.sources.raw import land_raw, scan_raw
from renown.sources.snapshots import (
    conform,
    empty_facts,
    latest_date,
    replace_snapshots,
    scan_snapshots,
    store_path,
)

MONDAY, TUESDAY = datetime.date(2026, 4, 20), datetime.date(2026, 4, 21)


def facts(spark, *rows):
    """Rows of (name, source, date, score)."""
    return spark.createDataFrame(
        [(n, "id", s, d, score, None, None, None) for n, s, d, score in rows], FACT_SCHEMA
    )


def stored(spark, root):
    return sorted(
        (r.entity_name, r.source, r.snapshot_date, r.score)
        for r in scan_snapshots(spark, root).collect()
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "snapshots")


def test_rerun_replaces_only_its_dates(spark, root):
    first = [("a", "x", MONDAY, 1), ("a", "x", TUESDAY, 2), ("a", "y", TUESDAY, 3)]
    replace_snapshots(facts(spark, *first), root)
    replace_snapshots(facts(spark, *first), root)
    assert stored(spark, root) == first
    # y is absent this time and does not linger; Monday stays.
    replace_snapshots(facts(spark, ("a", "x", TUESDAY, 9)), root)
    assert stored(spark, root) == [("a", "x", MONDAY, 1), ("a", "x", TUESDAY, 9)]
    replace_snapshots(empty_facts(spark), root)
    assert len(stored(spark, root)) == 2


def test_store_may_feed_its_own_rerun(spark, root):
    replace_snapshots(facts(spark, ("a", "x", MONDAY, 1), ("b", "x", TUESDAY, 2)), root)
    replace_snapshots(latest_snapshot(scan_snapshots(spark, root)), root)
    assert [r[0] for r in stored(spark, root)] == ["a", "b"]


def test_failed_write_keeps_the_old_snapshot(spark, root):
    replace_snapshots(facts(spark, ("a", "x", MONDAY, 1)), root)
    poisoned = facts(spark, ("b", "x", MONDAY, 2)).selectExpr(
        *[c for c in FACT_COLUMNS if c != "tags"], "raise_error('lost') AS tags"
    )
    with pytest.raises(Exception, match="lost"):
        replace_snapshots(poisoned, root)
    assert stored(spark, root) == [("a", "x", MONDAY, 1)]


def test_schema_and_latest(spark, root):
    replace_snapshots(facts(spark, ("a", "x", MONDAY, 1), ("b", "y", TUESDAY, 2)), root)
    loaded = scan_snapshots(spark, root)
    assert loaded.columns == FACT_COLUMNS
    assert dict(loaded.dtypes)["snapshot_date"] == "date"
    assert latest_date(loaded) == TUESDAY
    assert latest_date(enabled_only(loaded, ["x"])) == MONDAY
    for latest in (latest_snapshot(loaded), latest_snapshot(loaded, as_of="2026-04-21")):
        assert [r.entity_name for r in latest.collect()] == ["b"]
    assert latest_snapshot(loaded, dates=loaded.where("source = 'x'")).count() == 1


def test_published_view_has_the_public_column_names(spark):
    publish_view(facts(spark, ("a", "lastfm", MONDAY, 1), ("a", "off", MONDAY, 1)), ["lastfm"])
    rows = spark.sql("SELECT artist_name, platform, popularity_score FROM artist_popularity")
    assert [tuple(r) for r in rows.collect()] == [("a", "lastfm", 1)]
    assert "spotify" not in enabled_sources() and len(enabled_sources()) == 8


def test_conform(spark):
    loose = spark.createDataFrame(
        [("a", "5", "junk", "2026-04-20"), ("b", "9" * 30, "7", "soon")],
        "entity_name string, score string, reach string, snapshot_date string",
    )
    rows = conform(loose.withColumnRenamed("absent", "x")).collect()
    assert [(r.score, r.reach, r.snapshot_date) for r in rows] == [
        (5, None, MONDAY),
        (None, 7, None),
    ]
    assert conform(loose).schema == conform(empty_facts(spark)).schema


def test_paths():
    assert store_path("/data/x") == "/data/x"
    assert store_path("/data/x", "hdfs://host:9000/") == "hdfs://host:9000/data/x"


def test_raw_landing(spark, tmp_path):
    root = str(tmp_path / "raw")

    def land(*rows):
        land_raw(
            spark.createDataFrame(rows, "source string, snapshot_date date, payload string"), root
        )

    land(
        ("deezer", MONDAY, '{"name":\n "a",\n "nb_fan": 1}'),
        ("deezer", TUESDAY, '{"name": "b"'),
        ("itunes", MONDAY, '{"name": "c"}'),
    )
    land(("deezer", MONDAY, '{"name": "d"}'))
    monday = scan_raw(spark, root, "deezer", MONDAY).collect()
    assert [(r.name, r._corrupt_record) for r in monday] == [("d", None)]
    tuesday = scan_raw(spark, root, "deezer", TUESDAY).collect()
    assert [(r.name, r._corrupt_record) for r in tuesday] == [(None, '{"name": "b"')]
    assert scan_raw(spark, root, "itunes").count() == 1
    assert scan_raw(spark, root, "wikidata").count() == 0


def test_a_day_without_facts_ends_empty(spark, tmp_path):
    root = str(tmp_path / "store")
    facts = conform(
        spark.createDataFrame(
            [("a", "2026-01-01"), ("b", "2026-01-02")], "entity_name string, snapshot_date string"
        )
    )
    replace_snapshots(facts, root)
    replace_snapshots(facts.limit(0), root, "2026-01-01")
    assert [r.entity_name for r in scan_snapshots(spark, root).collect()] == ["b"]


def test_an_undated_fact_fails(spark, tmp_path):
    undated = conform(spark.createDataFrame([("a",)], "entity_name string"))
    with pytest.raises(Exception, match="without snapshot_date"):
        replace_snapshots(undated, str(tmp_path / "store"))


def test_lines_are_landed_without_a_sort(spark, tmp_path, monkeypatch):
    """A task writes the folders it gets side by side, also more than it may hold open; the setting comes back."""
    from pyspark.sql.conf import RuntimeConfig

    name, seen, put = "spark.sql.maxConcurrentOutputFileWriters", [], RuntimeConfig.set
    monkeypatch.setattr(RuntimeConfig, "set", lambda self, key, value: (seen.append((key, str(value))), put(self, key, value))[1])
    rows = spark.range(300).selectExpr(
        "'deezer' AS source", "date_add(DATE'2026-01-01', int(id % 100)) AS snapshot_date", "concat('{\"id\":', id, '}') AS payload"
    )
    before = spark.conf.get(name)
    land_raw(rows.coalesce(1), str(tmp_path / "raw"))
    opened = [int(v) for k, v in seen if k == name]
    assert len(opened) == 2 and opened[0] > 1 and spark.conf.get(name) == before
    found = scan_raw(spark, str(tmp_path / "raw"), "deezer")
    assert sorted(int(r[0]) for r in found.selectExpr("try_variant_get(id, '$', 'string')").collect()) == list(range(300))


def _landed_files(root):
    return sorted(p for p in root.rglob("part-*") if p.stat().st_size)


def test_landed_lines_are_packed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    """Plain files of an earlier landing are read like packed ones, and replaced by a rerun."""
    monkeypatch.setattr("renown.sources.raw.FILE_LINES", 10)
    root = tmp_path / "raw"
    plain = root / "source=deezer" / "snapshot_date=2026-04-20"
    plain.mkdir(parents=True)
    (plain / "part-old.txt").write_text('{"name":"old"}\n')
    assert [r.name for r in scan_raw(spark, str(root), "deezer").collect()] == ["old"]
    rows = spark.range(35).selectExpr("'deezer' AS source", f"DATE'{TUESDAY}' AS snapshot_date", "concat('{\"name\":\"', id, '\"}') AS payload")
    land_raw(rows.coalesce(1), str(root))
    assert sorted(r.name for r in scan_raw(spark, str(root), "deezer").collect()) == sorted(["old", *map(str, range(35))])
    land_raw(rows.coalesce(1).selectExpr("source", f"DATE'{MONDAY}' AS snapshot_date", "payload"), str(root))
    assert scan_raw(spark, str(root), "deezer").count() == 70
    files = _landed_files(root)
    assert len(files) == 8 and all(p.read_bytes()[:2] == b"\x1f\x8b" for p in files)


def test_dealt_lines_land_where_they_are(spark, tmp_path):
    """No shuffle: each task keeps its rows and their order."""
    rows = spark.range(0, 90, 1, 3).selectExpr("'deezer' AS source", f"DATE'{MONDAY}' AS snapshot_date", "concat('{\"id\":', id, '}') AS payload")
    land_raw(rows, str(tmp_path / "raw"), dealt=True)
    texts = sorted([r.value for r in spark.read.text(str(p)).collect()] for p in _landed_files(tmp_path / "raw"))
    assert texts == sorted([f'{{"id":{i}}}' for i in range(k, k + 30)] for k in (0, 30, 60))


def test_no_shuffle_files_stay_after_landing(spark, tmp_path):
    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = on_disk(), spark.conf.get(name, "false")
    rows = spark.range(0, 3000, 1, 6).selectExpr("'deezer' AS source", f"DATE'{MONDAY}' AS snapshot_date", "concat('{\"id\":', id, '}') AS payload")
    land_raw(rows, str(tmp_path / "raw"))
    until = time.time() + 20  # they are removed in the background
    while (left := on_disk() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(name, "false") == setting
    assert scan_raw(spark, str(tmp_path / "raw"), "deezer").count() == 3000
