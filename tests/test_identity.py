from pyspark.sql import functions as F

from renown.operators import identity
from renown.operators.claims import claim_ids, ordered_labels
from renown.operators.rolling import rolling_months


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def table(spark, schema, *records):
    return spark.createDataFrame(list(records), schema)


IDS = "entity_name string, entity_id string, seq long"


def test_priority_id_merge(spark):
    primary = table(spark, IDS, ("a", "p1", 1), ("a", "p2", 2), ("b", "", 3), ("", "p9", 4))
    secondary = table(
        spark, IDS, ("a", "s1", 1), ("b", "s2", 5), ("b", "s3", 4), ("c", None, 1), ("d", "s4", 1)
    )
    merged = identity.priority_id_merge(primary, secondary)
    assert rows(merged, "entity_name", "entity_id") == [("a", "p2"), ("b", "s3"), ("d", "s4")]
    known = identity.with_known_id(table(spark, "entity_name string", ("a",), ("z",)), merged)
    assert rows(known, "entity_name") == [("a",)]


def test_title_lookup(spark):
    entities = table(
        spark,
        "entity_name string, title_override string, search_title string",
        ("Own", None, "Other"),
        ("Over", "Override", "Own"),
        ("Search", None, "Found"),
        ("Same", None, "Same"),
        ("Blank", None, ""),
        ("Lost", "Nowhere", None),
    )
    pages = table(
        spark, "page_title string, views long", ("Own", 1), ("Override", 2), ("Found", 3), ("Over", 4)
    )
    assert rows(identity.title_lookup(entities, pages), "entity_name", "page_title", "views") == [
        ("Over", "Override", 2),
        ("Own", "Own", 1),
        ("Search", "Found", 3),
    ]


def test_detail_replaces_the_whole_record(spark):
    search = table(spark, "id long, a string, b string", (1, "s", "s"), (2, "s", None))
    detail = table(spark, "id long, b string, a string", (1, None, "d"))
    merged = identity.detail_over_search(search, detail, "id")
    assert rows(merged, "id", "a", "b") == [(1, "d", None), (2, "s", None)]


def test_best_hit(spark):
    hits = table(spark, "name string, place long, v string", ("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"))
    best = identity.best_hit(hits, ["name"], [F.col("place")])
    assert rows(best, "name", "v") == [("a", "y"), ("b", "z")]


def test_incremental_enrichment(spark):
    record = "entity_name string, genre string"
    entities = table(spark, "entity_name string", ("hit",), ("new",), ("nothing",))
    cache = table(spark, record, ("hit", "old"), ("unused", "old"))
    lookups = table(spark, record, ("hit", "ignored"), ("new", "fresh"), ("unused", "ignored"))
    assert rows(identity.cache_misses(entities, cache), "entity_name") == [("new",), ("nothing",)]
    enriched = identity.enrich_incrementally(entities, cache, lookups)
    assert rows(enriched, "entity_name", "genre", "from_cache") == [
        ("hit", "old", True),
        ("new", "fresh", False),
    ]
    assert rows(identity.merged_cache(cache, enriched), "entity_name", "genre") == [
        ("hit", "old"),
        ("new", "fresh"),
        ("unused", "old"),
    ]


def test_claims(spark):
    def entity(*values):
        claims = ",".join(f'{{"mainsnak":{{"datavalue":{{"value":{v}}}}}}}' for v in values)
        return f'{{"claims":{{"P136":[{claims}],"P31":[{{}}]}}}}'

    texts = [entity('{"id":"Q1"}', "{}", '"text"', '{"id":""}', '{"id":"Q2"}'), entity(), "{}"]
    df = table(spark, "n long, j string", *enumerate(texts)).select(
        "n", claim_ids(F.parse_json("j")).alias("ids")
    )
    assert rows(df, "n", "ids") == [(0, ["Q1", "Q2"]), (1, []), (2, [])]


def test_labels_keep_order_and_look_up_ten_ids(spark):
    ids = [f"Q{i}" for i in range(12)]
    records = table(
        spark,
        "key long, ids array<string>",
        (1, ["Q3", "Q1", "none", "Q3", "blank"]),
        (2, ids[:10] + ["Q11", "Q2"]),
        (3, ["none"]),
        (4, []),
    )
    labels = table(spark, "id string, label string", ("blank", ""), *[(q, f"l{q}") for q in ids])
    found = ordered_labels(records, labels, "key", max_ids=10)
    assert rows(found, "key", "labels") == [
        (1, ["lQ3", "lQ1", "lQ3"]),
        (2, [f"lQ{i}" for i in range(10)] + ["lQ2"]),
    ]
    every = ordered_labels(records, labels, "key").where("key = 2")
    assert rows(every, "labels") == [([f"lQ{i}" for i in range(10)] + ["lQ11", "lQ2"],)]


def test_rolling_window_crosses_the_year(spark):
    monthly = table(
        spark,
        "page_title string, month string, views long",
        ("a", "2025-10-01", 100),
        ("a", "2025-11-01", 1),
        ("a", "2025-12-01", 2),
        ("a", "2026-02-01", 50),
        ("b", "2026-01-01", 7),
        ("c", "2026-02-01", 7),
    ).withColumn("month", F.col("month").cast("date"))
    windowed = rolling_months(monthly, "2026-02-14")
    columns = ("page_title", "period_start", "period_end", "latest_month_views", "total_window_views")
    assert rows(windowed, *columns) == [
        ("a", "2025110100", "2026010100", 2, 3),
        ("b", "2025110100", "2026010100", 7, 7),
    ]
