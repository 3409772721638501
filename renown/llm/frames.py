"""Small DataFrame helpers that the text operators share."""

from __future__ import annotations

import shutil
import tempfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.session import work_dir
from renown.sources.files import delete

#: What a blank is for word and chunk rules: space and \\x09 to \\x0D.
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(name: str, modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


#: Rows per batch handed to Python workers while a stage is written. Texts may be long and a batch is held as a
#: whole on both sides, so few rows bound the memory of a task.
BATCH_ROWS, BATCH_SETTING = 512, "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> str:
    """Few rows per batch from now on, for jobs over whole texts that the caller starts; the setting before."""
    before = spark.conf.get(BATCH_SETTING)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return before


@contextmanager
def small_batches(spark: SparkSession):
    """Fewer rows per batch for the jobs inside; the session's setting comes back afterwards."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


class Stage:
    """Intermediate tables in one fresh folder that all executors share.

    A written table cuts the lineage: it outlives lost executors and has no
    partitioning left, so that a later join may split its hot keys.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, work_dir(spark), 0
        self.tables: list[tuple[str, DataFrame]] = []

    def keep(self, df: DataFrame, schema=None, partition_by: str | None = None) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        with small_batches(self.spark):
            df.write.parquet(path, partitionBy=partition_by)
        kept = self.spark.read.schema(schema or df.schema).parquet(path)
        self.tables.append((path, kept))
        return kept

    def clear(self, *needed: DataFrame) -> None:
        """Delete all tables but the ``needed`` ones, which lazy results still read."""
        for path, kept in self.tables:
            if not any(kept is n for n in needed):
                delete(self.spark, path)
        self.tables = [t for t in self.tables if any(t[1] is n for n in needed)]


def only_ids(docs: DataFrame, ids: DataFrame, name: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``name`` is (or, left_anti, is not) in the one column of ``ids``.

    The id column is renamed, so no other column of ``docs`` can clash, and null
    ids match null ids.
    """
    other = ids.toDF("_wanted_id")
    return docs.join(other, docs[name].eqNullSafe(other["_wanted_id"]), how)


def bounded_rows(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of all their columns; equal rows count once.

    A first pass finds the greatest hash that is in, a second takes the rows, so no row is
    moved but those that are taken.
    """
    drawn = rows.withColumn("_draw", F.xxhash64(*rows.columns))
    last = drawn.select("_draw").distinct().orderBy("_draw").limit(most).agg(F.max("_draw")).first()[0]
    return drawn.where(F.col("_draw") <= F.lit(last).cast("long")).dropDuplicates(["_draw"]).drop("_draw")


#: Rows of a (bigint) id table that may be broadcast: 2 million are some 32 MB.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of a few numbers per row, marked for broadcast if its row count is within ``limit``."""
    return F.broadcast(df) if df.count() <= limit else df


def ship(spark: SparkSession) -> None:
    """Hand this package to the workers, wherever the driver found it; once per context."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if not any(f.endswith("/renown.zip") for f in context.listFiles):
        packed = shutil.make_archive(f"{tempfile.mkdtemp()}/renown", "zip", package.parent, package.name)
        context.addPyFile(packed)
