"""Benchmark decontamination: size-partitioned MinHash containment, native functions only.

A short item inside a long document has a tiny resemblance but a high
containment, so the sketches are those of the items. Items are dealt into size
partitions (powers of two of their shingle count). An item with n shingles is
inside a document with containment t when at most (1 - t) n of them are
missing, so of its k smallest hash values at least k - (1 - t) n must occur there. Each
partition has its own k, large enough for its longest items, and thus its own
bound on the hash values that a document must offer: no link can be lost, and a
document hands on only the small hash values. Candidates are then verified on
the shingles as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage, only_ids, small, text_of

#: Words are runs of letters and digits of any script, compared in lower case.
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words of a text, none for an empty text."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def shingles(words_col: str, n: int) -> Column:
    """Runs of ``n`` words as structs; a shorter text with words is one shingle, padded with empty words."""
    w = F.when(
        F.size(words_col) >= n, F.col(words_col)
    ).when(F.size(words_col) > 0, F.concat(F.col(words_col), F.array_repeat(F.lit(""), n - F.size(words_col))))
    count = F.size(w) - (n - 1)
    return F.arrays_zip(*[F.slice(w, F.lit(i + 1), count).alias(f"w{i}") for i in range(n)])


def _shingle_rows(df: DataFrame, id_col: str, text_col: str, n: int, name: str) -> DataFrame:
    tokens = df.select(F.col(id_col).alias(name), words(text_of(text_col)).alias("words"))
    return tokens.select(name, F.inline_outer(shingles("words", n))).where(F.col("w0").isNotNull())


def hash_rows(df: DataFrame, id_col: str, text_col: str, n: int, name: str) -> DataFrame:
    """``name, h``: a 64-bit hash per shingle occurrence. Words are hashed once, then their runs."""
    tokens = df.select(F.col(id_col).alias(name), words(text_of(text_col)).alias("words"))
    coded = tokens.select(name, F.transform("words", lambda w: F.xxhash64(w)).alias("coded"))
    blank = F.xxhash64(F.lit(""))
    w = F.when(F.size("coded") >= n, F.col("coded")).when(
        F.size("coded") > 0, F.concat(F.col("coded"), F.array_repeat(blank, n - F.size("coded")))
    )
    padded = coded.select(name, w.alias("coded"))
    count = F.size("coded") - (n - 1)
    runs = F.arrays_zip(*[F.slice("coded", F.lit(i + 1), count).alias(f"c{i}") for i in range(n)])
    return padded.where(F.col("coded").isNotNull()).select(name, F.inline(runs)).select(
        name, F.xxhash64(*[f"c{i}" for i in range(n)]).alias("h")
    )


def sketches(items: DataFrame, id_col: str, text_col: str, n: int, threshold: float, spare: int) -> DataFrame:
    """``item_id, h, need, n_shingles, bound``: the smallest hash values of each item.

    ``need`` is how many of an item's values a document must hold at least;
    ``bound`` is the largest value in the item's size partition.
    """
    each = hash_rows(items, id_col, text_col, n, "item_id").distinct()
    lists = each.groupBy("item_id").agg(F.array_sort(F.collect_set("h")).alias("hs"))
    size = F.size("hs")
    upper = F.pow(F.lit(2), F.ceil(F.log2(size))).cast("int")
    lose = lambda s: F.floor(F.lit(1 - threshold) * s + F.lit(1e-9)).cast("int")
    sized = lists.select(
        "item_id", "hs", size.alias("n_shingles"), upper.alias("upper")
    ).withColumn("k", F.least("n_shingles", lose(F.col("upper")) + spare))
    cut = sized.select(
        "item_id",
        "upper",
        "n_shingles",
        (F.col("k") - lose(F.col("n_shingles"))).alias("need"),
        F.slice("hs", F.lit(1), F.col("k")).alias("hs"),
    )
    bounds = cut.groupBy("upper").agg(F.max(F.element_at("hs", -1)).alias("bound"))
    return cut.join(bounds, "upper").select(
        "item_id", "n_shingles", "need", "bound", F.explode("hs").alias("h")
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    spare: int = 3,
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles, containment`` where a document holds an item.

    Containment is the share of an item's distinct shingles that occur in the
    document, at least ``threshold``. Null and empty texts hold and are nothing;
    texts of fewer than ``n`` words have one shingle. Rows that share an id count
    as one text with all their shingles, null ids included; empty tables give no rows; other columns are not read.
    Cost is one pass over the documents, plus the pairs found.
    """
    store = Stage(docs.sparkSession)
    sketch = store.keep(sketches(items, item_col, item_text_col, n, threshold, spare))
    top = sketch.agg(F.max("bound").alias("b")).first()["b"]
    if top is None:
        top = -(1 << 63)
    offered = hash_rows(docs, id_col, text_col, n, "doc_id").where(F.col("h") <= F.lit(top))
    hits = offered.join(small(sketch), "h").groupBy("doc_id", "item_id", "h").agg(
        F.min("need").alias("need")
    )
    pairs = store.keep(
        hits.groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n"), F.min("need").alias("need"))
        .where("n >= need")
        .select("doc_id", "item_id")
    )
    # the shingles as text, of the documents and items that are candidates
    found = store.keep(pairs.select("doc_id").distinct())
    near = only_ids(docs, small(found), id_col)
    cols = [f"w{i}" for i in range(n)]
    asked = _shingle_rows(items, item_col, item_text_col, n, "item_id").distinct()
    total = asked.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    asked = store.keep(asked)
    held = _shingle_rows(near, id_col, text_col, n, "doc_id")
    held = held.join(small(asked), cols).select("doc_id", "item_id", *cols).distinct()
    shared = held.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    left = pairs.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"))
    same = F.col("_d").eqNullSafe(F.col("doc_id")) & F.col("_i").eqNullSafe(F.col("item_id"))
    shared = shared.join(left, same, "left_semi")
    part = F.col("n_shared") / F.col("n_shingles")
    joined = shared.withColumnRenamed("item_id", "_item").join(
        total, F.col("_item").eqNullSafe(F.col("item_id"))
    )
    return joined.where(part >= threshold).select(
        "doc_id", F.col("_item").alias("item_id"), "n_shared", "n_shingles", part.alias("containment")
    )


def without_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were.

    Rows without an id cannot be told apart and all stay.
    """
    leaks = contained_items(docs, items, id_col, **options).where("doc_id IS NOT NULL")
    leaks = leaks.select("doc_id").distinct()
    return only_ids(docs, small(Stage(docs.sparkSession).keep(leaks)), id_col, "left_anti")
