"""Raw source records: landing as JSON Lines and typed scans.

Broken text never fails a job: a field that does not fit is null or VARIANT,
and a line that is no record keeps its text in a column of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: Folders a task writes side by side; only a task with more of them sorts the rest of its rows by folder.
OPEN_FOLDERS, OPEN_SETTING = 64, "spark.sql.maxConcurrentOutputFileWriters"
#: Landed files are packed, so each is read by one task; a task begins another file after so many lines.
FILE_LINES = 250_000
#: With it Spark removes the shuffle files of a write as soon as that has ended.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The fields each source delivers. Fields whose type or presence
# varies are VARIANT.
_FIELDS = {
    "spotify": "id VARIANT, followers VARIANT, popularity VARIANT, genres VARIANT",
    "lastfm": "mbid VARIANT, stats VARIANT, tags VARIANT",
    "deezer": "id VARIANT, nb_fan VARIANT",
    "musicbrainz": "id VARIANT, rating VARIANT, tags VARIANT",
    "listenbrainz": "artist_mbid VARIANT, total_listen_count VARIANT, listeners VARIANT",
    "wikimedia": "page_title VARIANT, latest_month_views VARIANT, total_window_views VARIANT",
    "theaudiodb": "idArtist VARIANT, strGenre VARIANT, strStyle VARIANT, strMood VARIANT",
    "itunes": "artistId VARIANT, primaryGenreName STRING",
    "wikidata": "id VARIANT, genre_labels VARIANT",
}
RAW_SOURCES = tuple(_FIELDS)


def raw_schema(source: str) -> T.StructType:
    """Declared schema of one source; no inference pass over the files."""
    return T.StructType.fromDDL(
        f"source_artist_name STRING, name STRING, {_FIELDS[source]}, {CORRUPT} STRING"
    )


def to_payload(records: DataFrame, source: str, snapshot_date) -> DataFrame:
    """Any records as (source, snapshot_date, payload) with one JSON text each."""
    return records.select(
        F.lit(source).alias("source"),
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        F.to_json(F.struct("*")).alias("payload"),
    )


def land_raw(payloads: DataFrame, root: str, dealt: bool = False) -> None:
    """Write (source, snapshot_date, payload) as JSON Lines below ``root``, packed with gzip.

    A rerun replaces the (source, date) folders it brings and no others. The
    rebalance splits a source that holds most of the rows over many files. Lines go straight to the
    files of their folders, so a task holds none of them however many it gets. Rows that are ``dealt``
    evenly already are written where they are: lines are the longest form of the data, and a
    shuffle would write them to disk once more. Shuffle files go with the end of the write.
    """
    one_line = F.regexp_replace("payload", r"[\r\n]+", " ").alias("value")
    spark = payloads.sparkSession
    before = {OPEN_SETTING: spark.conf.get(OPEN_SETTING), CLEANUP_SETTING: spark.conf.get(CLEANUP_SETTING, "false")}
    spark.conf.set(OPEN_SETTING, str(max(int(before[OPEN_SETTING]), OPEN_FOLDERS)))
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        (
            (payloads if dealt else payloads.hint("rebalance", "source", "snapshot_date"))
            .select("source", "snapshot_date", one_line)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", FILE_LINES)
            .option("compression", "gzip")
            .partitionBy("source", "snapshot_date")
            .text(root)
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def raw_lines(spark: SparkSession, root: str) -> DataFrame:
    """All landed lines as (payload, source, snapshot_date); filters prune folders.

    Share it between sources, so that the folders are listed once.
    """
    lines = spark.read.schema("value STRING, source STRING, snapshot_date DATE").text(root)
    return lines.withColumnRenamed("value", "payload")


def of_source(lines: DataFrame, source: str, snapshot_date=None) -> DataFrame:
    """Typed records of one source; a source that was not landed gives no rows.

    A blank line is no record and is kept as one in CORRUPT.
    """
    wanted = lines.where(F.col("source") == source)
    if snapshot_date is not None:
        wanted = wanted.where(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    return parse_raw(wanted, source)


def scan_raw(spark: SparkSession, root: str, source: str, snapshot_date=None) -> DataFrame:
    """Typed scan of one landed source."""
    return of_source(raw_lines(spark, root), source, snapshot_date)


def parse_raw(payloads: DataFrame, source: str, column: str = "payload") -> DataFrame:
    """Typed columns from JSON text; text that is no record is kept in CORRUPT.

    ``inline`` keeps the parse in an operator of its own. As a plain projection
    it would be merged into the mappers and repeated for every field they read.
    """
    return payloads.select(_record(raw_schema(source), column))


def parse_lines(lines: DataFrame) -> DataFrame:
    """``source`` and the typed columns of all sources; those another source delivers are mostly null."""
    fields = {f.name: f for source in RAW_SOURCES for f in raw_schema(source).fields}
    corrupt = fields.pop(CORRUPT)
    return lines.select("source", _record(T.StructType([*fields.values(), corrupt]), "payload"))


def _record(schema: T.StructType, column: str) -> Column:
    parsed = F.from_json(
        column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    unreadable = F.struct(
        *[
            (
                F.coalesce(F.col(column), F.lit("")) if f.name == CORRUPT
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )
    return F.inline(F.array(F.coalesce(F.when(F.trim(column) != "null", parsed), unreadable)))
