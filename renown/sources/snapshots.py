"""The snapshot store: Parquet files per snapshot date, replaced date by date.

A date is the unit of replacement: a rerun swaps the whole date, and a source that is
missing this time does not linger. The files of a date lie in the folder of the write
that made them (``v=<version>/snapshot_date=<date>``); which one counts is told by
``renown.sources.versions``.

Every row is stored with the key of its name. Rows are dealt out by that key and sorted by
it, so all rows of a name on a date share one file and a few neighbouring pages, and a filter on
``entity_key`` skips the rest by bloom filters and page statistics.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renown.functions.names import canonical_key
from renown.model import FACT_COLUMNS, FACT_SCHEMA
from renown.operators.snapshot import enabled_only
from renown.sources import files, versions

#: The stored key of the name; reports and queries do not see it.
KEY = "entity_key"
DATE = "snapshot_date"
STORE_SCHEMA = T.StructType([*FACT_SCHEMA.fields, T.StructField(KEY, T.StringType())])


def store_path(root: str, filesystem: str | None = None) -> str:
    """Join an optional file system address and a path, without a double slash."""
    if not filesystem:
        return root
    return f"{filesystem.rstrip('/')}/{root.lstrip('/')}"


def conform(df: DataFrame) -> DataFrame:
    """Fact columns in order and type: missing ones null, others dropped.

    Values that do not fit the type become null instead of failing the job.
    """
    return df.select(
        *[
            (
                F.col(field.name).try_cast(field.dataType)
                if field.name in df.columns
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in FACT_SCHEMA.fields
        ]
    )


def empty_facts(spark: SparkSession) -> DataFrame:
    """No rows, right schema."""
    return spark.createDataFrame([], FACT_SCHEMA)


def _part(date) -> str:
    """The folder of a date inside a version."""
    return f"{DATE}={date}"


def write_version(facts: DataFrame, root: str, only_date=None) -> tuple[str, list[str]]:
    """Write facts as a version nobody reads yet; the version and the dates it holds.

    With ``only_date`` all facts are of that date, and the version holds it even without
    facts. A fact without a date fails the write: it has no folder to be found in. The rebalance
    cuts a name that holds most of the rows into several files of even size.
    """
    spark, version = facts.sparkSession, versions.new_version()
    target = versions.folder(root, version)
    dated = F.coalesce(DATE, F.raise_error(F.lit("fact without snapshot_date")).cast("date"))
    keyed = facts.select(*FACT_COLUMNS, canonical_key("entity_name").alias(KEY)).withColumn(DATE, dated)

    def writer(rows: DataFrame):
        return (
            rows.write.option("compression", "snappy")
            .option(f"parquet.bloom.filter.enabled#{KEY}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )

    if only_date is not None:
        rows = keyed.drop(DATE).hint("rebalance", KEY).sortWithinPartitions(KEY, "source")
        writer(rows).parquet(f"{target}/{_part(only_date)}")
        return version, [str(only_date)]
    rows = keyed.hint("rebalance", DATE, KEY).sortWithinPartitions(DATE, KEY, "source")
    writer(rows).partitionBy(DATE).parquet(target)
    found = files.names(spark, target)
    return version, [n.removeprefix(f"{DATE}=") for n in found if n.startswith(f"{DATE}=")]


def replace_snapshots(facts: DataFrame, root: str, only_date=None) -> None:
    """Write facts, replacing every date they contain and no other date.

    With ``only_date`` all facts are of that date, which is replaced even by nothing.
    The new files are complete before a date's pointer moves, so lost executors or a job that
    fails in any stage leave the old snapshot in place, and the store may feed its own rerun.
    """
    version, dates = write_version(facts, root, only_date)
    versions.publish(facts.sparkSession, root, dates, version)


def vacuum_snapshots(spark: SparkSession, root: str, older_than: timedelta = timedelta(days=3)) -> list[str]:
    """Remove the files of replaced snapshots and of failed writes; see ``versions.vacuum``."""
    return versions.vacuum(spark, root, _part, older_than)


def stored_dates(spark: SparkSession, root: str) -> list[datetime.date]:
    """The stored dates, newest first, from one listing."""
    return sorted(map(datetime.date.fromisoformat, versions.current(spark, root)), reverse=True)


def snapshot_dates(spark: SparkSession, root: str) -> DataFrame:
    """The stored dates as a table (snapshot_date, version, replacements), without a look at the data."""
    rows = [
        (datetime.date.fromisoformat(p.unit), p.version, p.number)
        for p in versions.current(spark, root).values()
    ]
    return spark.createDataFrame(rows, "snapshot_date date, version string, replacements long")


def _paths(spark: SparkSession, root: str, dates: Iterable | None) -> list[str]:
    live = versions.current(spark, root)
    wanted = live if dates is None else {str(d) for d in dates}
    return [f"{versions.folder(root, p.version)}/{_part(u)}" for u, p in live.items() if u in wanted]


def scan_keyed(spark: SparkSession, root: str, dates: Iterable | None = None) -> DataFrame:
    """Stored facts with the key of the name, of all dates or of those given.

    A store without such dates gives no rows; a folder that does not exist is an error.
    """
    paths = _paths(spark, root, dates)
    if paths:
        # Which versions count was settled by the listing, so theirs are the only folders read.
        stored = spark.read.schema(STORE_SCHEMA).option("basePath", root).parquet(*paths)
        return stored.select(*FACT_COLUMNS, KEY)
    if not files.exists(spark, root):
        raise FileNotFoundError(f"no snapshot store at {root}")
    return spark.createDataFrame([], STORE_SCHEMA)


def scan_snapshots(spark: SparkSession, root: str, dates: Iterable | None = None) -> DataFrame:
    """Stored facts, with the fixed schema and column order."""
    return scan_keyed(spark, root, dates).select(*FACT_COLUMNS)


def scan_entity(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored facts, of all dates, whose name has the key of ``name``: all its spellings, whatever they are called today.

    The key is worked out first, so that the scan is an equality on a stored column.
    """
    key = spark.range(1).select(canonical_key(F.lit(name))).first()[0]
    return scan_keyed(spark, root).where(F.col(KEY) == key).select(*FACT_COLUMNS)


def newest_date(
    spark: SparkSession, root: str, sources: Iterable[str] | None = None
) -> datetime.date | None:
    """The newest date with a row of one of the sources, None if there is none.

    Dates come from the listing and are tried newest first, each by a read of one date that ends at
    its first row. History is never read: the first try decides unless a day is empty.
    """
    for day in stored_dates(spark, root):
        rows = enabled_only(scan_snapshots(spark, root, [day]).where(F.col(DATE) == F.lit(day)), sources)
        if rows.select("source").head(1):
            return day
    return None


def latest_date(facts: DataFrame) -> datetime.date | None:
    """The newest snapshot date of any facts, one value brought to the driver."""
    return facts.agg(F.max("snapshot_date")).first()[0]


def stored_columns(spark: SparkSession, root: str, dates: Iterable | None = None) -> DataFrame:
    """What the files of each date really hold: (snapshot_date, position, column, stored_type).

    Old files may lack columns that a scan under the declared schema fills with null. One write makes
    all files of a date, so one footer a date tells; no row is read.
    """
    rows = [
        (datetime.date.fromisoformat(path.rpartition("=")[2]), k, f.name, f.dataType.simpleString())
        for path in _paths(spark, root, dates)
        for k, f in enumerate(spark.read.parquet(path).schema.fields)
    ]
    return spark.createDataFrame(
        rows, "snapshot_date date, position int, column string, stored_type string"
    )
