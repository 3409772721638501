"""How the registered queries read their tables."""

import datetime
import gzip
import json
from pathlib import Path

import pytest

from registry.queries import registered
from renown.sources.raw import RAW_SOURCES, land_raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    customers = [(k, f"Customer#{k:09d}", k % 7, "BUILDING") for k in range(12)]
    orders = [(k, k % 14, "OPF"[k % 3], 1000.5 * k, datetime.datetime(1995 + k % 3, 2, 3), f"{1 + k % 2}-URGENT") for k in range(80)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").coalesce(
        1
    ).write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame(
        orders,
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    ).coalesce(1).write.parquet(f"{root}/orders.parquet")
    return root


@pytest.mark.parametrize("name", ["normalize_union", "normalize_union_all", "normalize_union_first_five"])
def test_nine_sources_share_one_reading_of_the_facts(spark, tables, name):
    union = registered()[name](spark, tables)
    assert not [f for f in union.inputFiles() if "orders.parquet" in f]
    assert {r.source for r in union.select("source").distinct().collect()} >= {"deezer", "spotify", "wikidata"}


def test_union_and_landed_lines_agree(spark, tables):
    union, landed = (registered()[n](spark, tables) for n in ("normalize_union", "normalize_landed"))
    assert sorted(map(str, union.collect())) == sorted(map(str, landed.collect()))


def test_one_file_of_orders_is_dealt_to_all_cores(spark, tables):
    labels = registered()["nested_labels"](spark, tables)
    assert labels.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert labels.count() == 80


def test_facts_of_an_entity_land_side_by_side(spark, tables, monkeypatch):
    """Its lines are in one file of a source, all nine sources packed, with no shuffle of lines."""
    landed = []

    def land(payloads, root, **options):
        assert payloads.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and options == {"dealt": True}
        land_raw(payloads, root, **options)
        landed.append(root)

    monkeypatch.setattr("registry.queries.land_raw", land)
    registered()["normalize_landed"](spark, tables)
    files = sorted(Path(landed[0]).rglob("part-*.gz"))
    assert {p.parent.parent.name for p in files} == {f"source={s}" for s in RAW_SOURCES}
    ids = [{json.loads(line).get("id") for line in gzip.open(p, "rt")} for p in files if "source=deezer" in str(p)]
    assert len(set.union(*ids)) == sum(map(len, ids)) == 12
