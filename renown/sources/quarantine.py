"""Records no fact could be made of, kept by date as JSON Lines beside their reason.

A date is replaced as a whole, as in the snapshot store, so a clean rerun empties it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from renown.sources import versions

SCHEMA = "reject_reason string, record string, source string, snapshot_date date"


def write_quarantine(rejects: DataFrame, root: str, date) -> str:
    """Write the rejects of one date as a version nobody reads yet."""
    version = versions.new_version()
    target = f"{versions.folder(root, version)}/snapshot_date={date}"
    rejects.select("source", "reject_reason", "record").write.partitionBy("source").json(target)
    return version


def scan_quarantine(spark: SparkSession, root: str, dates: Iterable | None = None) -> DataFrame:
    """(source, snapshot_date, reject_reason, record) of all dates or of those given."""
    wanted = None if dates is None else {str(d) for d in dates}
    paths = [
        f"{versions.folder(root, p.version)}/snapshot_date={unit}"
        for unit, p in versions.current(spark, root).items()
        if wanted is None or unit in wanted
    ]
    if not paths:
        rows = spark.createDataFrame([], SCHEMA)
    else:
        rows = spark.read.schema(SCHEMA).option("basePath", root).json(paths)
    return rows.select("source", "snapshot_date", "reject_reason", "record")
