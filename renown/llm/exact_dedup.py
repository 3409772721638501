"""Exact deduplication by content-defined chunk recipes, with native functions only.

A text, freed of blanks, is cut where its own characters say so; a chunk gets a
64-bit identifier, and a document is then the ordered list of its identifiers.
Equal lists are equal texts. What moves is eight bytes per chunk and a list per
document, never a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import BLANKS, Stage, only_ids, text_of

#: A cut lies between a character of the first class and one of the second. Text
#: without such a pair is cut by length alone, at the same places in equal texts.
CUT_AFTER = r"dgkpuvwzDGKPUVWZ.!?;039\u00e1-\u00e9\u3002"
CUT_BEFORE = r"bfjmqxyBFJMQXY\u00f3-\u00fa48\u4e00-\u5fff"


def chunk_pattern(least: int, most: int) -> str:
    """Chunks of ``least`` characters, then up to the next cut, ``most`` at the longest."""
    return f"(?s).{{{least},{most}}}?(?<=[{CUT_AFTER}])(?=[{CUT_BEFORE}])|.{{1,{most}}}"


def recipes(docs: DataFrame, id_col: str, text_col: str, least: int, most: int, bits: int) -> DataFrame:
    """``doc_id, n_chars, sha, pieces``; a piece has its identifier and the digest that proves it."""
    bare = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text_of(text_col)).cast("long").alias("n_chars"),
        F.regexp_replace(text_of(text_col), BLANKS + "+", "").alias("bare"),
    )
    cut = bare.select(
        "doc_id",
        "n_chars",
        F.sha2("bare", 256).alias("text_sha256"),
        F.regexp_extract_all("bare", F.lit(chunk_pattern(least, most)), F.lit(0)).alias("chunks"),
    )
    mask = (1 << bits) - 1 if bits < 64 else -1
    return cut.select(
        "doc_id",
        "n_chars",
        "text_sha256",
        F.transform(
            "chunks",
            lambda c: F.struct(
                F.xxhash64(c).bitwiseAND(F.lit(mask)).alias("id"),
                F.unhex(F.sha2(c, 256)).alias("proof"),
            ),
        ).alias("pieces"),
    )


def _ambiguous(store: Stage, made: DataFrame) -> DataFrame:
    """Chunks whose identifier another chunk has too, with their rank among these."""
    chunk = store.keep(made.select(F.inline("pieces")).distinct())
    shared = chunk.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    alike = chunk.join(shared, "id", "left_semi")
    smaller = alike.select("id", F.col("proof").alias("below"))
    return (
        alike.join(smaller, "id")
        .where(F.col("below") < F.col("proof"))
        .groupBy("id", "proof")
        .agg(F.count("*").alias("rank"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 512,
    most: int = 4096,
    bits: int = 64,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when they are identical without blanks; null counts as
    empty, and all empty texts are one group. Of a group the row with the most
    code points in its original text stays, of several the one with the smallest id,
    a null id coming last. Rows that share their id share the decision, so a row that is
    repeated whole is kept as often as it occurs; ``group_size`` counts every
    row. An empty table gives no rows. Other columns are not read.

    Every chunk identifier is verified: distinct chunks with one identifier are
    told apart by SHA-256 and numbered, and the numbers enter the lists.
    """
    spark = docs.sparkSession
    store = Stage(spark)
    made = recipes(docs, id_col, text_col, least, most, bits)
    ranks = store.keep(_ambiguous(store, made))
    if ranks.isEmpty():
        listed = made.withColumn("recipe", F.transform("pieces", lambda p: p["id"]))
    else:
        listed = _ranked(made, ranks)
    listed = listed.select("doc_id", "n_chars", "text_sha256", "recipe")
    listed = store.keep(listed)
    by_length = listed.groupBy("recipe", "n_chars").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n")
    )
    groups = by_length.groupBy("recipe").agg(
        F.max_by("first_id", "n_chars").alias("keep_id"), F.sum("n").alias("group_size")
    )
    several = groups.where("group_size > 1").withColumnRenamed("recipe", "of")
    several = store.keep(several)
    joined = listed.join(several, listed["recipe"] == several["of"], "left")
    lone = F.col("of").isNull()
    return joined.select(
        "doc_id",
        F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (lone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def _ranked(made: DataFrame, ranks: DataFrame) -> DataFrame:
    """Recipes in which identifiers with a rank carry it; only documents that hold one are rebuilt."""
    rows = made.withColumn("row", F.struct("doc_id", "n_chars", "text_sha256"))
    each = rows.select("row", F.posexplode("pieces").alias("at", "piece")).select(
        "row", "at", "piece.id", "piece.proof"
    )
    salted = each.join(ranks, ["id", "proof"], "left").select(
        "row", "at", F.array("id", F.coalesce("rank", F.lit(0).cast("long"))).alias("pair")
    )
    lists = salted.groupBy("row").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_set(F.struct("at", "pair"))), lambda x: x["pair"])
        ).alias("recipe"),
        (F.count("*") / F.count_distinct("at")).cast("int").alias("times"),
    )
    full = lists.select("row.*", F.explode(F.array_repeat("recipe", F.col("times"))).alias("recipe"))
    none = made.where(F.size("pieces") == 0).select(
        "doc_id", "n_chars", "text_sha256", F.array().cast("array<bigint>").alias("recipe")
    )
    return full.select(*none.columns).unionByName(none)


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, all columns as they were.

    Rows without an id cannot be told apart and all stay.
    """
    dropped = exact_groups(docs, id_col, text_col).where("NOT kept AND doc_id IS NOT NULL")
    dropped = dropped.select("doc_id").distinct()
    return only_ids(docs, Stage(docs.sparkSession).keep(dropped), id_col, "left_anti")
