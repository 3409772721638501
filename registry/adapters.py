"""Driver tables in the shape of the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.model import FACT_COLUMNS, Metric, SourceSpec

SALES_SIGNALS = (
    Metric("urgent_reach", "1-URGENT", "reach"),
    Metric("high_reach", "2-HIGH", "reach"),
    Metric("medium_reach", "3-MEDIUM", "reach"),
    Metric("unspecified_volume", "4-NOT SPECIFIED", "volume"),
    Metric("low_score", "5-LOW", "score"),
)
SALES_SCORECARD = (
    Metric("urgent_reach", "1-URGENT", "reach"),
    Metric("urgent_volume", "1-URGENT", "volume"),
    Metric("high_reach", "2-HIGH", "reach"),
    Metric("medium_reach", "3-MEDIUM", "reach"),
    Metric("unspecified_volume", "4-NOT SPECIFIED", "volume"),
    Metric("low_score", "5-LOW", "score"),
)
SALES_SORT = ("urgent_reach", "high_reach", "medium_reach")
SALES_TAG_PRIORITY = ("1-URGENT", "5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH")

# "trial" never occurs, so a required source is missing.
EVENT_SPECS = (
    SourceSpec("click", required=True, min_coverage=0.95),
    SourceSpec("error", min_coverage=0.5),
    SourceSpec("purchase", required=True, min_coverage=0.9, max_score=100),
    SourceSpec("signup", min_coverage=0.75),
    SourceSpec("view", required=True),
    SourceSpec("trial", required=True, min_coverage=0.5),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str):
    return F.sum(F.round(F.col(column) * 100).cast("bigint"))


def obs_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity = customer, source = order priority, snapshot = year of the order.

    Orders are summed up before the join, so a customer with most of the orders
    reaches it as a handful of rows.
    """
    year = F.trunc(F.col("o_orderdate").cast("date"), "year")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderpriority").alias("source"), year.alias("snapshot_date"))
        .agg(
            F.floor(F.max("o_totalprice") / 1000).cast("bigint").alias("score"),
            F.count("*").alias("reach"),
            _cents("o_totalprice").alias("volume"),
            # One letter; its code keeps the aggregate hash-based.
            F.char(F.min(F.ascii("o_orderstatus"))).alias("status"),
        )
    )
    return (
        per_customer.join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        .withColumns(
            {
                "entity_name": F.col("c_name"),
                "entity_id": F.col("c_custkey").cast("string"),
                "tags": F.concat_ws(", ", F.lower("c_mktsegment"), "status"),
            }
        )
        .select(*FACT_COLUMNS)
    )


def sales_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot dates of ``obs_sales`` without its sums."""
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("newest"))
        .join(known, "o_custkey", "left_semi")
        .select(F.trunc(F.col("newest").cast("date"), "year").alias("snapshot_date"))
    )


def obs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity = user, source = event type, snapshot = week."""
    week = F.trunc(F.col("ts").cast("date"), "week")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("event_type").alias("source"), week.alias("snapshot_date"))
        .agg(
            F.floor(F.max("value")).cast("bigint").alias("score"),
            F.count("*").alias("reach"),
            _cents("value").alias("volume"),
            F.min(F.get_json_object("props", "$.k")).alias("k"),
        )
        .withColumns(
            {
                "entity_name": F.concat(F.lit("User "), F.col("user_id").cast("string")),
                "entity_id": F.col("user_id").cast("string"),
                "tags": F.concat(F.lit("k"), "k"),
            }
        )
        .select(*FACT_COLUMNS)
    )


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs_events`` with a fault for every check on rows.

    A null key, negative and unbounded scores and duplicates, each tied to a digit of the id so that
    SQL can repeat it.
    """
    faulty = obs_events(spark, sf_dir).withColumns(
        {
            "score": F.col("score") - 50,
            "entity_id": F.nullif(F.col("entity_id"), F.lit("7")),
        }
    )
    return faulty.unionByName(faulty.where("entity_id LIKE '%3'"))


def thin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``faulty_events`` with a source that few entities have, for the checks of coverage.

    The null id of a signup belongs to entity 7, which the thin source lacks.
    """
    return faulty_events(spark, sf_dir).where("source <> 'signup' OR entity_id < '5'")


def expected_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names the event checks expect: all users but those ending in 9."""
    return (
        table(spark, sf_dir, "events")
        .select(F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("entity_name"))
        .where("entity_name NOT LIKE '%9'")
        .distinct()
    )


def spelling_variants(facts: DataFrame) -> DataFrame:
    """Each source spells the name its own way."""
    return facts.withColumn(
        "entity_name",
        F.expr(
            """CASE source
                 WHEN '1-URGENT' THEN upper(entity_name)
                 WHEN '2-HIGH' THEN replace(entity_name, '#', ' & ')
                 WHEN '3-MEDIUM' THEN replace(entity_name, 'o', 'ö')
                 WHEN '4-NOT SPECIFIED' THEN replace(entity_name, '#', '-')
                 ELSE concat(entity_name, '!') END"""
        ),
    )


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, entity_name): all customers, nation 3 unknown, nation 5 respelled later."""
    customers = table(spark, sf_dir, "customer")
    listed = customers.where("c_nationkey <> 3").select(
        F.col("c_custkey").alias("seq"), F.col("c_name").alias("entity_name")
    )
    respelled = customers.where("c_nationkey = 5").select(
        (F.col("c_custkey") + 1_000_000_000_000).alias("seq"),
        F.upper("c_name").alias("entity_name"),
    )
    return listed.unionByName(respelled)
