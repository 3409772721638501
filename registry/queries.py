"""Every operator applied to the driver tables.

Dates are shown as text and lists as joined text, so that results compare flat.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.adapters import (
    EVENT_SPECS,
    SALES_SCORECARD,
    SALES_SIGNALS,
    SALES_SORT,
    SALES_TAG_PRIORITY,
    customer_entities,
    expected_users,
    faulty_events,
    obs_events,
    obs_sales,
    sales_dates,
    spelling_variants,
    table,
    thin_events,
)
from registry.payloads import BROKEN_DEEZER, PAYLOADS
from renown.functions import variants as v
from renown.functions.names import canonical_key
from renown.functions.tags import SHORT_LIST
from renown.model import SourceSpec
from renown.operators import checks, identity
from renown.operators.claims import claim_ids, exploded_labels, nested_labels, ordered_labels
from renown.operators.normalize import accepted, normalize_all, normalize_lines, normalize_source, rejected
from renown.operators.ranking import signal_dense_rank, signal_percentile
from renown.operators.rolling import rolling_months
from renown.operators.signals import metric_rows, metric_signals, pivot_metrics, priority_tags
from renown.operators.snapshot import latest_snapshot, publish_view
from renown.plans import queries as q
from renown.session import work_dir
from renown.sources.dims import entity_dim
from renown.sources import versions
from renown.sources.cache import ROUND, cache_round, enrich_and_remember, load_cache
from renown.sources.files import create, delete, names
from renown.sources.raw import CORRUPT, land_raw, parse_raw, raw_lines, scan_raw
from renown.sources.snapshots import (
    conform,
    newest_date,
    replace_snapshots,
    scan_entity,
    scan_snapshots,
    snapshot_dates,
    stored_columns,
)

RUN_DATE = "2026-04-26"
_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    """Register a function of (spark, sf_dir) under a key."""

    def register(function):
        _REGISTRY[key] = function
        return function

    return register


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def _flat(df: DataFrame) -> DataFrame:
    """Dates and lists as text."""
    shown = []
    for name, kind in df.dtypes:
        if kind == "date":
            shown.append(F.date_format(name, "yyyy-MM-dd").alias(name))
        elif kind.startswith("array"):
            shown.append(F.array_join(name, "; ").alias(name))
        else:
            shown.append(F.col(name))
    return df.select(*shown)


def _latest_sales(spark, sf_dir):
    return latest_snapshot(obs_sales(spark, sf_dir), dates=sales_dates(spark, sf_dir))


def _latest_signals(spark, sf_dir):
    return metric_rows(_latest_sales(spark, sf_dir), SALES_SIGNALS)


# --- snapshots and signals -------------------------------------------------


@query("latest_snapshot")
def _(spark, sf_dir):
    return _flat(_latest_sales(spark, sf_dir))


@query("enabled_source_view")
def _(spark, sf_dir):
    sources = [s for s in SALES_TAG_PRIORITY if s != "2-HIGH"]
    publish_view(obs_sales(spark, sf_dir), sources, "sales_view")
    summary = spark.sql(
        """SELECT platform AS source, snapshot_date, count(*) AS n_rows,
                  sum(listeners) AS reach, max(genres) AS tags
           FROM sales_view GROUP BY platform, snapshot_date"""
    )
    return _flat(summary)


@query("metric_signals")
def _(spark, sf_dir):
    return metric_signals(_latest_sales(spark, sf_dir), SALES_SIGNALS)


@query("pivot_signals")
def _(spark, sf_dir):
    return pivot_metrics(_latest_sales(spark, sf_dir), SALES_SIGNALS)


@query("priority_tags")
def _(spark, sf_dir):
    best = priority_tags(SALES_TAG_PRIORITY).alias("primary_tags")
    return _latest_sales(spark, sf_dir).groupBy("entity_name").agg(best)


@query("signal_percentile")
def _(spark, sf_dir):
    return signal_percentile(_latest_signals(spark, sf_dir))


@query("signal_dense_rank")
def _(spark, sf_dir):
    return signal_dense_rank(_latest_signals(spark, sf_dir))


# --- analytical questions --------------------------------------------------


def _scorecard(spark, sf_dir, **options):
    return q.scorecard(
        _latest_sales(spark, sf_dir),
        metrics=SALES_SCORECARD,
        sort=SALES_SORT,
        tag_priority=SALES_TAG_PRIORITY,
        **options,
    )


def _composite_reach(spark, sf_dir, **options):
    return q.composite_reach(_latest_sales(spark, sf_dir), signals=SALES_SIGNALS, **options)


def _source_gap(spark, sf_dir, **options):
    return _flat(q.source_gap(_latest_sales(spark, sf_dir), signals=SALES_SIGNALS, **options))


def _tag_reach(spark, sf_dir, **options):
    return q.tag_reach(
        _latest_sales(spark, sf_dir),
        metrics=[(s, 1 if s.column == "score" else 0) for s in SALES_SIGNALS],
        stop_tags=("p",),
        **options,
    )


def _metadata_coverage(spark, sf_dir, **options):
    return q.metadata_coverage(
        _latest_sales(spark, sf_dir).withColumn("source", F.substring("source", 3, 20)),
        sources=("URGENT", "HIGH", "LOW"),
        tag_order=("LOW", "HIGH", "URGENT"),
        **options,
    )


# each question as its top list, and whole
for _question in (_scorecard, _composite_reach, _source_gap, _tag_reach, _metadata_coverage):
    query(_question.__name__[1:])(_question)
    query(f"{_question.__name__[1:]}_all")(partial(_question, n=None))


@query("entity_profile")
def _(spark, sf_dir):
    profile = q.entity_profile(
        obs_sales(spark, sf_dir), "customer#000000007", order=("5-LOW", "3-MEDIUM")
    )
    return _flat(profile)


@query("entity_profile_events")
def _(spark, sf_dir):
    return _flat(q.entity_profile(obs_events(spark, sf_dir), "User 7", exact=True))


@query("health_summary")
def _(spark, sf_dir):
    return _flat(q.health_summary(_latest_sales(spark, sf_dir)))


# --- quality gate ----------------------------------------------------------


@query("check_null_keys")
def _(spark, sf_dir):
    return _flat(checks.null_key_rows(faulty_events(spark, sf_dir)))


@query("check_negative")
def _(spark, sf_dir):
    return _flat(checks.negative_rows(faulty_events(spark, sf_dir)))


@query("check_bounds")
def _(spark, sf_dir):
    return _flat(checks.out_of_bounds_rows(faulty_events(spark, sf_dir), EVENT_SPECS))


@query("check_unexpected_names")
def _(spark, sf_dir):
    return checks.unexpected_names(faulty_events(spark, sf_dir), expected_users(spark, sf_dir))


@query("check_duplicates")
def _(spark, sf_dir):
    return _flat(checks.duplicate_groups(faulty_events(spark, sf_dir)))


@query("distinct_entities")
def _(spark, sf_dir):
    return checks.distinct_entities(faulty_events(spark, sf_dir))


@query("source_counts")
def _(spark, sf_dir):
    return checks.source_counts(faulty_events(spark, sf_dir))


@query("coverage_by_source")
def _(spark, sf_dir):
    return checks.coverage_by_source(
        latest_snapshot(thin_events(spark, sf_dir)), expected_users(spark, sf_dir), EVENT_SPECS
    )


@query("validation_report")
def _(spark, sf_dir):
    return checks.validation_report(
        thin_events(spark, sf_dir), expected_users(spark, sf_dir), EVENT_SPECS
    )


# --- identity --------------------------------------------------------------


@query("canonical_key")
def _(spark, sf_dir):
    return (
        spelling_variants(obs_sales(spark, sf_dir))
        .select("entity_name", canonical_key("entity_name").alias("entity_key"))
        .distinct()
    )


@query("canonicalize_names")
def _(spark, sf_dir):
    facts = spelling_variants(obs_sales(spark, sf_dir))
    return _flat(
        identity.canonicalize_names(facts, entity_dim(customer_entities(spark, sf_dir)))
    )


def _merged_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    primary = orders.selectExpr(
        "concat('C', o_custkey) AS entity_name",
        "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat('O', o_orderkey) END AS entity_id",
        "o_orderkey AS seq",
    )
    secondary = table(spark, sf_dir, "events").selectExpr(
        "concat('C', user_id) AS entity_name",
        "concat('E', event_id) AS entity_id",
        "event_id AS seq",
    )
    return identity.priority_id_merge(primary, secondary)


@query("priority_id_merge")
def _(spark, sf_dir):
    return _merged_ids(spark, sf_dir)


@query("semi_join_known")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "concat('C', c_custkey) AS entity_name", "c_mktsegment AS segment"
    )
    return identity.with_known_id(customers, _merged_ids(spark, sf_dir))


@query("override_fallback")
def _(spark, sf_dir):
    entities = table(spark, sf_dir, "customer").selectExpr(
        "concat('C', c_custkey) AS entity_name",
        "CASE WHEN c_nationkey < 5 THEN concat('C', c_custkey + 1) END AS title_override",
        "concat('C', c_nationkey) AS search_title",
    )
    pages = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("concat('C', o_custkey)").alias("page_title"))
        .agg(F.count("*").alias("views"))
    )
    return identity.title_lookup(entities, pages)


@query("detail_over_search")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    detail = part.where("p_size <= 25").selectExpr(
        "p_partkey",
        "upper(p_brand) AS p_brand",
        "nullif(p_type, 'ECONOMY') AS p_type",
        "p_size + 100 AS p_size",
    )
    return identity.detail_over_search(part, detail, "p_partkey")


@query("top1_per_key")
def _(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber"
    )
    order = [F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber"]
    return identity.best_hit(hits, ["l_orderkey"], order)


@query("incremental_enrich")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    cache = customers.where("c_nationkey < 10").selectExpr(
        "c_name AS entity_name", "c_mktsegment AS record"
    )
    lookups = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderpriority").alias("record"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr("c_name AS entity_name", "record")
    )
    entities = customers.selectExpr("c_name AS entity_name")
    return identity.enrich_incrementally(entities, cache, lookups)


@query("nested_claims")
def _(spark, sf_dir):
    claims = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """parse_json(concat('{"claims":{"P136":[{"mainsnak":{',
             CASE WHEN l_returnflag = 'R' THEN ''
                  ELSE concat('"datavalue":{"value":{"id":"Q', l_partkey, '"}}') END,
             '}},{"mainsnak":{"datavalue":{"value":{"id":"Q', l_suppkey, '"}}}}],"P31":[]}}'))
           AS entity""",
    )
    found = claims.select("l_orderkey", "l_linenumber", claim_ids(F.col("entity")).alias("ids"))
    return _flat(found)


def _ordered_label_join(spark, sf_dir, max_ids=None):
    records = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "transform(sequence(0, 11), i -> CASE i WHEN 11 THEN o_custkey + 34 "
        "ELSE o_custkey + i * 17 END) AS ids",
    )
    labels = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS label")
    return _flat(ordered_labels(records, labels, "o_orderkey", max_ids=max_ids))


# the labels of all ids (under both names), and of the first ten
query("ordered_label_join")(_ordered_label_join)
query("ordered_label_join_all")(_ordered_label_join)
query("ordered_label_join_first_ten")(partial(_ordered_label_join, max_ids=10))


def _spread(spark, df, *keys):
    """Rows dealt to all cores, by keys if there are any. Few small rows that become long texts would otherwise be worked off by few tasks."""
    return df.repartition(spark.sparkContext.defaultParallelism, *keys)


def _label_ids(spark, sf_dir):
    return _spread(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")).selectExpr(
        "o_orderkey", "transform(sequence(0, 11), i -> concat('Q', o_custkey * 3 + i * 17)) AS ids"
    )


@query("nested_labels")
def _(spark, sf_dir):
    """One response per order; some ids are absent from it, some have no label, some a blank one."""
    answered = _label_ids(spark, sf_dir).selectExpr(
        "o_orderkey",
        "ids",
        """parse_json(concat('{"entities":{', array_join(
             transform(filter(ids, id -> int(substr(id, 2)) % 7 <> 0), id -> concat(
               '"', id, '":{"labels":{', CASE int(substr(id, 2)) % 5 WHEN 0 THEN '' WHEN 1 THEN '"en":{"value":""}'
               ELSE concat('"en":{"language":"en","value":"genre ', int(substr(id, 2)) % 97, '"}') END, '}}')),
             ','), '}}')) AS response""",
    )
    return _flat(
        answered.select("o_orderkey", nested_labels(F.col("response"), F.col("ids")).alias("labels"))
    )


@query("exploded_labels")
def _(spark, sf_dir):
    """Responses apart from the records: one per part, which answers for itself and for an id that many share."""
    responses = table(spark, sf_dir, "part").selectExpr(
        """parse_json(concat('{"entities":{"Q', p_partkey, '":{"labels":{"en":{"value":"', p_name,
             '"}}},"Q', 1000000000 + p_partkey % 3, '":{"labels":{"en":{"value":"shared ', p_partkey % 3,
             '"}}}}}')) AS response"""
    )
    records = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "array(concat('Q', o_custkey), concat('Q', 1000000000 + o_orderkey % 4), concat('Q', o_custkey + 1)) AS ids",
    )
    return _flat(ordered_labels(records, exploded_labels(responses), "o_orderkey"))


@query("rolling_month_window")
def _(spark, sf_dir):
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").cast("string").alias("page_title"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        )
        .agg(F.count("*").alias("views"))
    )
    return rolling_months(monthly, "1998-06-15", months_back=6)


# --- raw records -----------------------------------------------------------


def _payloads(facts, source, payload):
    return facts.select(
        F.lit(source).alias("source"), "snapshot_date", F.expr(payload).alias("payload")
    )


def _raw_by_source(facts, payloads):
    return {s: parse_raw(_payloads(facts, s, payload), s) for s, payload in payloads.items()}


def _typed(raw):
    return raw.select(
        "source_artist_name",
        "name",
        v.text(F.col("id")).alias("id"),
        v.whole(F.col("nb_fan")).alias("nb_fan"),
        F.is_variant_null("nb_fan").alias("nb_fan_is_null"),
        F.col(CORRUPT).alias("broken_line"),
    )


@query("raw_json_scan")
def _(spark, sf_dir):
    root = f"{work_dir(spark)}/raw"
    land_raw(_payloads(obs_sales(spark, sf_dir), "deezer", BROKEN_DEEZER), root)
    return _typed(scan_raw(spark, root, "deezer"))


@query("raw_json_roundtrip")
def _(spark, sf_dir):
    root = f"{work_dir(spark)}/raw"
    facts = obs_sales(spark, sf_dir)

    def land(rows, fans):
        land_raw(
            rows.select(
                F.lit("deezer").alias("source"),
                "snapshot_date",
                F.to_json(F.struct("entity_name", fans.alias("nb_fan"))).alias("payload"),
            ),
            root,
        )

    land(facts, F.col("reach"))
    land(latest_snapshot(facts), F.col("reach") + 1)
    return (
        spark.read.schema("entity_name STRING, nb_fan BIGINT, snapshot_date DATE, source STRING")
        .json(root)
        .transform(_flat)
    )


@query("conform_schema")
def _(spark, sf_dir):
    loose = obs_sales(spark, sf_dir).selectExpr(
        "'dropped' AS extra",
        "CAST(snapshot_date AS STRING) AS snapshot_date",
        "CASE WHEN entity_id LIKE '%9' THEN 'n/a' ELSE CAST(score AS STRING) END AS score",
        "CAST(reach AS INT) AS reach",
        "source",
        "entity_name",
        "entity_id",
    )
    return _flat(conform(loose))


@query("quarantine_split")
def _(spark, sf_dir):
    raw = _raw_by_source(obs_sales(spark, sf_dir), {**PAYLOADS, "deezer": BROKEN_DEEZER})
    broken = rejected(normalize_all(raw, RUN_DATE))
    malformed = F.when(F.col("reject_reason") == "malformed JSON", F.col("record"))
    return broken.groupBy("source", "reject_reason").agg(
        F.count("*").alias("n_rows"), F.min(malformed).alias("first_malformed")
    )


def _normalized(source, **options):
    def run(spark, sf_dir):
        raw = parse_raw(_payloads(obs_sales(spark, sf_dir), source, PAYLOADS[source]), source)
        dim = entity_dim(customer_entities(spark, sf_dir))
        return _flat(accepted(normalize_source(raw, source, RUN_DATE, dim, **options)))

    return run


NORMALIZERS = {
    "norm_nested_struct": "spotify",
    "norm_stats_tags": "lastfm",
    "norm_fan_count": "deezer",
    "norm_rating_tags": "musicbrainz",
    "norm_array_size": "listenbrainz",
    "norm_window_views": "wikimedia",
    "norm_join_nonempty": "theaudiodb",
    "norm_catalog": "itunes",
    "norm_claim_labels": "wikidata",
}
for _key, _source in NORMALIZERS.items():
    query(_key)(_normalized(_source))
# the sources with tag lists: whole under both names, and the short lists
TAG_LISTS = ("norm_nested_struct", "norm_stats_tags", "norm_rating_tags", "norm_claim_labels")
for _key in TAG_LISTS:
    query(f"{_key}_all")(_normalized(NORMALIZERS[_key]))
    query(f"{_key}_first_five")(_normalized(NORMALIZERS[_key], max_tags=SHORT_LIST))


def _stored(spark, df):
    """The rows through files, so that many readers do not work them out once each, nor wait for one long task."""
    path = f"{work_dir(spark)}/stored"
    _spread(spark, df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _normalize_union(spark, sf_dir, **options):
    raw = _raw_by_source(_stored(spark, obs_sales(spark, sf_dir)), PAYLOADS)
    raw["unheard_of"] = raw["deezer"]
    dim = entity_dim(customer_entities(spark, sf_dir))
    return _flat(accepted(normalize_all(raw, RUN_DATE, dim, **options)))


query("normalize_union")(_normalize_union)
query("normalize_union_all")(_normalize_union)
query("normalize_union_first_five")(partial(_normalize_union, max_tags=SHORT_LIST))


@query("normalize_landed")
def _(spark, sf_dir):
    """All nine sources through files: landed as lines, read back and mapped in one scan.

    Facts are dealt before they become lines. An entity has a fact per source and year at most, and dealt by entity they
    stay side by side as the join left them, so that files and the shuffle by name pack what their lines share.
    """
    root = f"{work_dir(spark)}/raw"
    facts = _spread(spark, obs_sales(spark, sf_dir), "entity_id").withColumn("snapshot_date", F.lit(RUN_DATE).cast("date"))
    each = [
        F.struct(F.lit(s).alias("source"), F.expr(payload).alias("payload")) for s, payload in PAYLOADS.items()
    ]
    land_raw(facts.select("snapshot_date", F.inline(F.array(*each))), root, dealt=True)
    dim = entity_dim(customer_entities(spark, sf_dir))
    return _flat(accepted(normalize_lines(raw_lines(spark, root), RUN_DATE, dim)))


# --- snapshot store --------------------------------------------------------


def _store(spark):
    return f"{work_dir(spark)}/snapshots"


@query("scan_snapshots")
def _(spark, sf_dir):
    root = _store(spark)
    replace_snapshots(obs_events(spark, sf_dir), root)
    return _flat(latest_snapshot(scan_snapshots(spark, root)))


@query("snapshot_roundtrip")
def _(spark, sf_dir):
    root = _store(spark)
    facts = obs_sales(spark, sf_dir)
    replace_snapshots(facts, root)
    replace_snapshots(facts, root)
    return _flat(scan_snapshots(spark, root))


@query("snapshot_replace")
def _(spark, sf_dir):
    root = _store(spark)
    facts = obs_sales(spark, sf_dir)
    replace_snapshots(facts, root)
    rerun = latest_snapshot(facts).where("source = '1-URGENT'")
    replace_snapshots(rerun.withColumn("score", F.col("score") + 1), root)
    return _flat(scan_snapshots(spark, root))


@query("snapshot_failed_swap")
def _(spark, sf_dir):
    """A replacement that fails while it is written, with and without adaptive execution, changes nothing."""
    root = _store(spark)
    facts = obs_sales(spark, sf_dir)
    replace_snapshots(facts, root)
    newest = newest_date(spark, root)
    lost = F.when(F.col("entity_id").isNotNull(), F.raise_error(F.lit("lost in the write")).cast("string"))
    poisoned = latest_snapshot(facts, newest).withColumn("tags", lost)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    for setting in ("true", "false"):  # without it the write is the stage that fails
        spark.conf.set("spark.sql.adaptive.enabled", setting)
        try:
            replace_snapshots(poisoned, root, newest)
        except Exception as failure:
            if "lost in the write" not in str(failure):
                raise
        else:
            raise AssertionError("the poisoned write did not fail")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return _flat(scan_snapshots(spark, root))


@query("snapshot_newest")
def _(spark, sf_dir):
    """The newest date with rows of two sources, after one day became empty and the next kept others only."""
    root = _store(spark)
    facts = obs_events(spark, sf_dir)
    replace_snapshots(facts, root)
    last, before = sorted((r.snapshot_date for r in snapshot_dates(spark, root).collect()), reverse=True)[:2]
    day = F.col("snapshot_date")
    replace_snapshots(facts.limit(0), root, last)
    replace_snapshots(facts.where((day == F.lit(before)) & ~F.col("source").isin("view", "click")), root, before)
    newest = newest_date(spark, root, ["view", "click"])
    return _flat(scan_snapshots(spark, root, [newest]).where(day == F.lit(newest)))


@query("snapshot_dates")
def _(spark, sf_dir):
    """Which dates are stored and how often each was replaced, told by a listing."""
    root = _store(spark)
    facts = obs_sales(spark, sf_dir)
    replace_snapshots(facts, root)
    replace_snapshots(latest_snapshot(facts, newest_date(spark, root)), root)
    return _flat(snapshot_dates(spark, root).select("snapshot_date", "replacements"))


@query("entity_profile_stored")
def _(spark, sf_dir):
    """One entity out of a written store, by the stored key of its name, under its configured spelling."""
    root = _store(spark)
    replace_snapshots(spelling_variants(obs_sales(spark, sf_dir)), root)
    dim = entity_dim(table(spark, sf_dir, "customer").selectExpr("c_custkey AS seq", "c_name AS entity_name"))
    rows = identity.canonicalize_names(scan_entity(spark, root, "CUSTOMER-000000007"), dim, unknown=None)
    return _flat(q.entity_profile(rows, "customer#000000007", order=("5-LOW", "3-MEDIUM")))


@query("missing_columns_report")
def _(spark, sf_dir):
    """What files of older writers lack: the newest date is stored without tags and with a short score."""
    root = _store(spark)
    facts = obs_sales(spark, sf_dir)
    replace_snapshots(facts, root)
    newest, version = newest_date(spark, root), versions.new_version()
    old_style = latest_snapshot(facts, newest).drop("tags", "snapshot_date").withColumn("score", F.col("score").cast("int"))
    old_style.write.parquet(f"{versions.folder(root, version)}/snapshot_date={newest}")
    versions.publish(spark, root, [str(newest)], version)
    return _flat(checks.missing_columns_report(stored_columns(spark, root)))


# --- lookup cache ----------------------------------------------------------


@query("cache_roundtrip")
def _(spark, sf_dir):
    """Two rounds of lookups through a stored cache, a broken file beside the good ones, and a lost cache."""
    root = f"{work_dir(spark)}/cache"
    customers = table(spark, sf_dir, "customer")
    priorities = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("record"))
    )
    known = priorities.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    schema = "entity_name string, record string"

    def look_up(prefix):
        return lambda missing: known.selectExpr(
            "c_name AS entity_name", f"concat('{prefix}', record) AS record"
        ).join(missing, "entity_name", "left_semi")

    few = customers.where("c_nationkey < 10").selectExpr("c_name AS entity_name")
    enrich_and_remember(few, root, look_up("first "), schema)
    live = versions.folder(root, versions.current(spark, root)["cache"].version)
    create(spark, f"{live}/part-broken.parquet", b"no parquet at all")
    everyone = customers.selectExpr("c_name AS entity_name")
    second = enrich_and_remember(everyone, root, look_up("second "), schema)
    return second.withColumn("n_rounds", F.lit(cache_round(spark, root)).cast("long"))


@query("cache_lost_file")
def _(spark, sf_dir):
    """All files of the cache's newest version are broken: everything is looked up again and nothing fails."""
    root = f"{work_dir(spark)}/cache"
    names_of = table(spark, sf_dir, "customer").selectExpr("c_name AS entity_name")
    schema = "entity_name string, record string"

    def look_up(missing):
        return missing.select("entity_name", F.reverse("entity_name").alias("record"))

    enrich_and_remember(names_of, root, look_up, schema)
    live = versions.folder(root, versions.current(spark, root)["cache"].version)
    for name in names(spark, live):
        if name.endswith(".parquet"):
            delete(spark, f"{live}/{name}")
            create(spark, f"{live}/{name}", b"PAR1 torn")
    again = enrich_and_remember(names_of, root, look_up, schema)
    rounds = load_cache(spark, root, schema).select("entity_name", F.col(ROUND).alias("written_in"))
    return again.join(rounds, "entity_name")
