"""A durable cache of looked-up records, one per key, kept over many runs.

A run looks up only what the cache lacks and merges what it found. The merge writes a
new version and swaps one pointer, so a failed run leaves the old cache. A file that
cannot be read is passed over: its keys count as unknown and are looked up again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from renown.operators.identity import cache_misses, first_per_key
from renown.sources import versions

_UNIT = "cache"
#: Which round a record was written in; the later one wins.
ROUND = "cache_round"


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ROUND, T.LongType())])


def cache_round(spark: SparkSession, root: str) -> int:
    """How often the cache has been written."""
    live = versions.current(spark, root).get(_UNIT)
    return live.number if live else 0


def load_cache(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """The cached records with ``cache_round``; without a cache, or with files that cannot be read, so much less."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    live = versions.current(spark, root).get(_UNIT)
    if live is None:
        return spark.createDataFrame([], _stored(declared))
    return (
        spark.read.schema(_stored(declared))
        .option("ignoreCorruptFiles", "true")
        .option("ignoreMissingFiles", "true")
        .parquet(versions.folder(root, live.version))
    )


def remember(records: DataFrame, root: str, key: str = "entity_name") -> int:
    """Merge records into the cache, the new one of a key winning, and return the round.

    Among new records of one key the first in the order of the other columns counts; a null
    key is never cached. Rows are one per key and round, so no key is large.
    """
    spark = records.sparkSession
    turn = cache_round(spark, root) + 1
    old = load_cache(spark, root, records.schema)
    both = old.unionByName(records.withColumn(ROUND, F.lit(turn).cast("long")))
    others = [F.asc_nulls_last(c) for c in records.columns if c != key]
    merged = first_per_key(both.where(F.col(key).isNotNull()), [key], [F.desc(ROUND), *others])
    version = versions.new_version()
    merged.write.option("compression", "snappy").parquet(versions.folder(root, version))
    versions.publish(spark, root, [_UNIT], version)
    return turn


def enrich_and_remember(
    entities: DataFrame,
    root: str,
    look_up: Callable[[DataFrame], DataFrame],
    schema: T.StructType | str,
    key: str = "entity_name",
) -> DataFrame:
    """Records of the entities, from the cache or else from ``look_up``, and ``from_cache``.

    ``look_up`` takes the missing keys and returns records for those it knows; a key it returns
    nothing for gets no row and is not cached, so the next run asks again. Records are
    worked out once, for the cache, and read back from there.
    """
    spark = entities.sparkSession
    names = entities.select(key).where(F.col(key).isNotNull()).distinct()
    known = load_cache(spark, root, schema).select(F.col(key).alias("entity_name"))
    missing = cache_misses(names.withColumnRenamed(key, "entity_name"), known)
    found = look_up(missing.withColumnRenamed("entity_name", key))
    wanted = found.join(names, key, "left_semi")
    turn = remember(wanted, root, key)
    records = load_cache(spark, root, schema).join(names, key, "left_semi")
    return records.withColumn("from_cache", F.col(ROUND) < turn).drop(ROUND)


def vacuum_cache(spark: SparkSession, root: str, older_than: timedelta = timedelta(days=3)) -> list[str]:
    """Remove replaced versions; see ``versions.vacuum``."""
    return versions.vacuum(spark, root, older_than=older_than)
