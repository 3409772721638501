"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is the set of its five-word shingles, all of the same weight, as the set
similarity decides. Each shingle sends arrivals of a Poisson process with its weight as the rate,
each to a random register, and a register keeps whose arrival was first. Two documents agree in
a register with the Jaccard similarity of their sets. A document is done
as soon as no shingle's next arrival can beat its slowest register. Bands of
registers propose pairs, the texts decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage, only_ids, small, text_of
from renown.llm.hashing import BASE, U, forget_others, mix, parts, shingle_hashes, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 6
MASK = (1 << 64) - 1
#: Members up to which a bucket compares the classes it holds pair by pair.
SMALL_BUCKET = 4
EDGES_PER_PARTITION = 200_000
#: Members of a large bucket, and bytes of their shingles, that are compared with as many others in one call.
BLOCK, BLOCK_BYTES = 256, 4_000_000
#: Shingles in the columns of one matrix product.
TERMS_AT_ONCE = 4096


def weighted_shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, distinct shingle and weight, which is 1 however often the shingle occurs."""
    owner, shingle = shingle_hashes(*word_hashes(texts), WORDS)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return owner[at], shingle[at], np.ones(len(at))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U(11)).astype(np.float64) + 0.5) / (1 << 53)


def signatures(
    owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int
) -> np.ndarray:
    """The first shingle of each register, for ``n`` texts; 0 in texts without shingles."""
    first = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, U)
    limit = np.full(n, np.inf)
    time, draw = np.zeros(len(owner)), 0
    while len(owner):
        draw += 1
        h = mix(shingle + U(draw * int(BASE) & MASK))
        time = time - np.log(_uniform(h)) / weight
        live = time < limit[owner]
        owner, shingle, weight, time, h = (x[live] for x in (owner, shingle, weight, time, h))
        cell = owner * registers + (mix(h ^ BASE) % U(registers)).astype(np.int64)
        np.minimum.at(first, cell, time)
        won = first[cell] == time
        kept[cell[won]] = shingle[won]
        limit = first.reshape(n, registers).max(1)
    return kept.reshape(n, registers)


def band_hashes(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(kept), bands), U) + np.arange(1, bands + 1, dtype=U)
    for r in range(rows):
        h = mix(h * BASE + kept[:, r::rows][:, :bands])
    return h


def _sketch(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """``doc_id, k1, k2, n, bands, registers``: the text's identity, shingles, band hashes and 16 bits of each register."""
    chosen = docs.where(F.col(id_col).isNotNull())
    chosen = chosen.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        forget_others()
        for ids, texts in parts(batches, ("doc_id", "text"), 256):
            n = len(texts)
            words_of, words = word_hashes(texts)
            # the identity is the sequence of words, as two sums over place and word
            starts = np.searchsorted(words_of, np.arange(n))
            place = (np.arange(len(words)) - starts[words_of] + 1).astype(U) if n else words
            keys = []
            for salt in (U(1), U(2)):
                total = np.zeros(n, U)
                np.add.at(total, words_of, mix(mix(words + salt) + place * BASE))
                keys.append(total.view(np.int64))
            weighted = weighted_shingles(texts)
            kept = signatures(*weighted, n, bands * rows)
            hashes = band_hashes(kept, bands, rows).view(np.int64)
            empty = starts == np.searchsorted(words_of, np.arange(n), "right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    *(pa.array(k, pa.int64()) for k in keys),
                    pa.array(np.bincount(weighted[0], minlength=n), pa.int64()),
                    pa.array([[] if e else h for h, e in zip(hashes.tolist(), empty)], pa.list_(pa.int64())),
                    pa.array([k.tobytes() for k in (kept & U(0xFFFF)).astype(np.uint16)], pa.binary()),
                ],
                ["doc_id", "k1", "k2", "n", "bands", "registers"],
            )

    return chosen.mapInArrow(
        run, "doc_id long, k1 long, k2 long, n long, bands array<long>, registers binary"
    )


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of shingles."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The ``a, b`` whose texts are similar enough. Pairs come ordered by ``b``, which is read once in a row."""
    with_a = pairs.join(texts.toDF("a", "text_a"), "a")
    with_b = with_a.join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        forget_others()
        last, last_b = None, None
        for a, b, text_a, text_b in parts(batches, ("a", "b", "text_a", "text_b"), 64):
            owner, shingle, _ = weighted_shingles(text_a)
            cut = np.searchsorted(owner, np.arange(len(a) + 1))
            good = []
            for i in range(len(a)):
                if b[i] != last_b:
                    last_b, last = b[i], weighted_shingles([text_b[i]])[1]
                good.append(similarity(shingle[cut[i] : cut[i + 1]], last) >= threshold)
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.int64)[keep], pa.int64()) for x in (a, b)], ["a", "b"]
            )

    return with_b.mapInArrow(run, "a long, b long")


def _promising(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` and the share of equal registers, where the numbers of shingles leave a chance of ``threshold``.

    Two sets are no more similar than the smaller is to the larger, which is exact; the
    share only says which partner is the likeliest.
    """
    r = sketch.select("doc_id", "n", "registers")
    with_a = pairs.join(r.toDF("a", "na", "ra"), "a").join(r.toDF("b", "nb", "rb"), "b")
    able = with_a.where(F.least("na", "nb") / F.greatest("na", "nb") >= threshold)

    def run(batches):
        for batch in batches:
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16) for c in ("ra", "rb"))
            n = batch.num_rows
            share = (ra == rb).reshape(n, -1).mean(1) if n else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(share)], ["a", "b", "share"]
            )

    return able.select("a", "b", "ra", "rb").mapInArrow(run, "a long, b long, share double")


def components(store: Stage, edges: DataFrame) -> DataFrame:
    """``doc_id, class`` of all ends of edges: the smallest id that a document is linked with, however far.

    Each round takes the least class of a document and of its neighbours, and
    then the class of that class; rounds end when nothing changes. The number of
    partitions follows the number of edges.
    """
    both = store.keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    n = 1 + both.count() // EDGES_PER_PARTITION
    both = both.coalesce(n)
    label = both.groupBy("a").agg(F.min("b").alias("least"))
    label = store.keep(label.select(F.col("a").alias("doc_id"), F.least("a", "least").alias("class"))).coalesce(n)
    changed = not label.isEmpty()
    while changed:
        near = both.join(label, both["b"] == label["doc_id"]).groupBy("a").agg(F.min("class").alias("best"))
        hooked = label.join(near, label["doc_id"] == near["a"]).select(
            "doc_id", F.col("class").alias("old"), F.least("class", "best").alias("class")
        )
        hooked = store.keep(hooked).coalesce(n)
        above = hooked.select(F.col("doc_id").alias("class"), F.col("class").alias("over"))
        jumped = hooked.join(above, "class").select("doc_id", "old", F.least("class", "over").alias("class"))
        jumped = store.keep(jumped).coalesce(n)
        changed = not jumped.where("old <> class").isEmpty()
        label = jumped.select("doc_id", "class")
    return label


def _merged(store: Stage, label: DataFrame, edges: DataFrame) -> DataFrame:
    """``label`` after more edges: their ends' classes are linked, and only these are gone through again."""
    ends = _classed(_classed(edges, label, "a", "class_a"), label, "b", "class_b").where("class_a <> class_b")
    ends = store.keep(ends.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    if ends.isEmpty():
        return label
    over = components(store, ends).toDF("_old", "_new")
    moved = label.join(over, label["class"] == over["_old"], "left")
    moved = moved.select("doc_id", F.coalesce("_new", "class").alias("class"))
    fresh = over.join(label, over["_old"] == label["doc_id"], "left_anti").toDF("doc_id", "class")
    return store.keep(moved.union(fresh))


def _classed(rows: DataFrame, label: DataFrame, key: str = "doc_id", name: str = "class") -> DataFrame:
    """``rows`` with the class of ``key``, a document without links being its own."""
    of = label.toDF("_of", "_class")
    found = rows.join(of, rows[key] == of["_of"], "left")
    return found.withColumn(name, F.coalesce("_class", key)).drop("_of", "_class")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, class_id, class_size`` for every row of ``docs`` with an id.

    Two documents are linked when the Jaccard similarity of their sets of five-word
    shingles is at least ``threshold``; a class is what links connect, its id the smallest
    doc_id. Words are runs of ASCII letters and digits and other characters,
    in lower case. Texts without words (null, empty) have no shingle and are
    classes of their own. Equal sequences of words are one class. A repeated id
    counts once per row. Rows without an id are left out. Empty in, empty out.

    A pair at 0.8 misses all bands with a probability of 2e-5. In a
    bucket all members meet its head, which is linear. Buckets that then still
    hold several classes compare these pair by pair if they are small. In a large
    one a document goes on only if the shingles that it does not have for itself alone leave it
    a chance of the threshold, which is exact; what goes on is compared block by block.
    """
    store = Stage(docs.sparkSession)
    sketch = store.keep(_sketch(docs, id_col, text_col, bands, rows))
    worded = sketch.where(F.size("bands") > 0)
    reps = store.keep(worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    ids = reps.select(F.col("rep").alias("doc_id"))
    # one row per representative, whichever of several rows with its id
    nodes = store.keep(worded.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    links = _Links(store, docs, id_col, text_col, nodes, threshold)
    buckets = nodes.select("doc_id", F.explode("bands").alias("bucket"))
    buckets, heads = _shared(store, buckets)
    # every member with the head of its bucket
    pairs = buckets.join(heads, "bucket").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    links.add(pairs.where("a <> b").distinct(), in_turns=True)
    # what small buckets that hold several classes still hide
    small_ones, _ = _mixed(store, buckets, heads, links.label)
    links.add(_pairs(small_ones))
    # and large ones
    _, large = _mixed(store, buckets, heads, links.label)
    links.add_classes(_linked_classes(store, *links.able(large), threshold))
    by_key = store.keep(_classed(reps, links.label, "rep").select("k1", "k2", "class"))
    lone = sketch.where(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"))
    found = worded.select("doc_id", "k1", "k2").join(by_key, ["k1", "k2"])
    every = store.keep(found.select("doc_id", F.col("class").alias("class_id")).union(lone))
    sizes = store.keep(every.groupBy("class_id").agg(F.count("*").alias("class_size")))
    store.clear(every, sizes)
    return every.join(sizes, "class_id").select("doc_id", "class_id", "class_size")


def _shared(store: Stage, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``bucket, doc_id`` of the buckets with two members or more, and ``bucket, head, size`` of these.

    The head is the member that shares its buckets with the most others, of
    several the smallest. Among the variants of one text that is the text they
    vary, which is linked with all of them even where they are not with each other.
    """
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = store.keep(rows.join(store.keep(sizes), "bucket").select("bucket", "doc_id", "size"))
    partners = store.keep(shared.groupBy("doc_id").agg(F.sum("size").alias("partners")))
    ranked = shared.join(partners, "doc_id").groupBy("bucket", "size", "partners")
    ranked = ranked.agg(F.min("doc_id").alias("head")).groupBy("bucket", "size")
    heads = ranked.agg(F.max_by("head", "partners").alias("head"))
    return shared.select("bucket", "doc_id"), store.keep(heads.select("bucket", "head", "size"))


def _mixed(store: Stage, buckets: DataFrame, heads: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``bucket, doc_id, class`` of the small and of the large buckets that hold several classes."""
    classed = store.keep(_classed(buckets, label))
    mixed = classed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = mixed.where("low < high").join(heads.select("bucket", "size"), "bucket")
    rows = store.keep(classed.join(store.keep(mixed.select("bucket", "size")), "bucket"))
    few = F.col("size") <= SMALL_BUCKET
    return rows.where(few).drop("size"), rows.where(~few).drop("size")


def _pairs(rows: DataFrame) -> DataFrame:
    """``a, b`` (``a`` above ``b``) of one bucket and of different classes."""
    other = rows.select("bucket", F.col("doc_id").alias("b"), F.col("class").alias("class_b"))
    pairs = rows.join(other, "bucket").where("class < class_b")
    return pairs.select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct()


def _linked_classes(store: Stage, rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` of the classes that a link inside a bucket connects, enough of them to connect all.

    ``rows`` are ``bucket, doc_id, class, n`` as :meth:`_Links.able` has them, ``sets`` the shingles
    per document. Links inside the largest class of a bucket tell nothing, so the members of all other
    classes are held against all members. Both are dealt into blocks, a pair of blocks
    is one row of the join and is compared exactly inside its task, which hands on a spanning
    forest of the classes it has seen.
    """
    counts = rows.groupBy("bucket", "class").agg(F.count("*").alias("size"))
    sizes = counts.groupBy("bucket").agg(
        F.sum("size").alias("size"), F.count("*").alias("classes"), F.max_by("class", "size").alias("largest")
    )
    sizes = store.keep(sizes.where("classes > 1"))
    told = rows.join(sizes.drop("classes"), "bucket").join(sets, "doc_id")
    weight = store.keep(told.groupBy("bucket").agg(F.sum(F.octet_length("shingles")).alias("bytes")))
    dealt = told.join(weight, "bucket").withColumn(
        "blocks", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    )
    member = F.struct("class", "n", "shingles")
    grouped = dealt.groupBy(
        "bucket", "blocks", F.pmod(F.xxhash64("doc_id"), "blocks").alias("block"), (F.col("class") == F.col("largest")).alias("inner")
    )
    grouped = store.keep(grouped.agg(F.collect_list(member).alias("members")))
    asking = grouped.where(~F.col("inner")).select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("members").alias("others")
    )
    both = asking.join(grouped, ["bucket", "block"]).select("others", "members")

    def columns(members):
        classes, n = (np.array([m[k] for m in members], np.int64) for k in ("class", "n"))
        return classes, n, [np.frombuffer(m["shingles"], U) for m in members]

    def run(batches):
        for left, right in parts(batches, ("others", "members"), 1):
            (classes, n, own), (classes_b, n_b, own_b) = columns(left[0]), columns(right[0])
            both = shared_counts(own, own_b)
            linked = (classes[:, None] != classes_b) & (both >= threshold * (np.add.outer(n, n_b) - both))
            i, j = np.nonzero(linked)
            pairs = np.unique(np.stack([classes[i], classes_b[j]], 1), axis=0)
            yield pa.RecordBatch.from_pylist(
                [{"a": int(x), "b": int(y)} for x, y in spanning(pairs.tolist())],
                pa.schema([("a", pa.int64()), ("b", pa.int64())]),
            )

    return both.mapInArrow(run, "a long, b long").distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left has in common with each on the right."""
    flat, flat_b = np.concatenate(left), np.concatenate(right)
    terms = np.intersect1d(flat, flat_b)
    total = np.zeros((len(left), len(right)))
    for start in range(0, len(terms), TERMS_AT_ONCE):
        some = terms[start : start + TERMS_AT_ONCE]
        holds = []
        for sets, all_of in ((left, flat), (right, flat_b)):
            owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            at = np.minimum(np.searchsorted(some, all_of), len(some) - 1)
            hit = some[at] == all_of
            matrix = np.zeros((len(sets), len(some)), np.float32)
            matrix[owner[hit], at[hit]] = 1
            holds.append(matrix)
        total += holds[0] @ holds[1].T
    return total


def spanning(pairs: list[list[int]]) -> list[list[int]]:
    """Those of ``pairs`` that connect what the ones before leave apart."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    kept = []
    for pair in pairs:
        x, y = map(top, pair)
        if x != y:
            above[x] = y
            kept.append(pair)
    return kept


class _Links:
    """Verified links so far, and the classes that follow from them."""

    def __init__(self, store: Stage, docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, threshold: float):
        self.store, self.docs, self.nodes, self.threshold = store, docs, nodes, threshold
        self.id_col, self.text_col = id_col, text_col
        spark = docs.sparkSession
        self.tried = spark.createDataFrame([], "a long, b long")
        self.texts = spark.createDataFrame([], "doc_id long, text string")
        self.label = spark.createDataFrame([], "doc_id long, class long")

    def _apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that have no common class."""
        both = _classed(_classed(pairs, self.label, "a", "class_a"), self.label, "b", "class_b")
        return both.where("class_a <> class_b").drop("class_a", "class_b")

    def able(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of large buckets whose document can have a link to another class in its bucket, with ``n``; and sets.

        The second table holds ``doc_id, shingles`` of all documents of ``rows``.

        Of the n shingles of a document, f occur in other documents of ``rows``, whatever their
        class. A partner has m shingles, at least the bucket's least; their intersection
        has at most f, so their similarity is at most f / (n + m - f).
        """
        store, threshold = self.store, self.threshold
        ids = store.keep(rows.select("doc_id").distinct())
        found = only_ids(self.docs, small(ids), self.id_col)
        found = found.select(F.col(self.id_col).cast("long").alias("doc_id"), text_of(self.text_col).alias("text"))

        def sets_of(batches):
            for keys, texts in parts(batches, ("doc_id", "text"), 256):
                owner, shingle, _ = weighted_shingles(texts)
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([shingle[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
                    ],
                    ["doc_id", "shingles"],
                )

        def run(batches):
            for keys, sets in parts(batches, ("doc_id", "shingles"), 256):
                shingle = np.frombuffer(b"".join(sets), U)
                key = np.repeat(np.array(keys, np.int64), [len(x) // 8 for x in sets])
                order = np.lexsort((key, shingle))
                shingle, key = shingle[order], key[order]
                first = np.ones(len(key), bool)
                first[1:] = shingle[1:] != shingle[:-1]
                last = np.append(first[1:], True)[: len(key)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shingle[first].view(np.int64), pa.int64()),
                        pa.array(key[first], pa.int64()),
                        pa.array(key[last], pa.int64()),
                    ],
                    ["shingle", "low", "high"],
                )

        # a shingle that several documents of a task have is one row by now
        sets = store.keep(found.mapInArrow(sets_of, "doc_id long, shingles binary").dropDuplicates(["doc_id"]))
        each = sets.mapInArrow(run, "shingle long, low long, high long")
        single = each.groupBy("shingle").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        own = single.where("low = high").groupBy(F.col("low").alias("doc_id")).agg(F.count("*").alias("own"))
        told = ids.join(self.nodes.select("doc_id", "n"), "doc_id").join(own, "doc_id", "left")
        told = store.keep(told.select("doc_id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("f")))
        sized = store.keep(rows.join(told, "doc_id"))
        least = sized.groupBy("bucket").agg(F.min("n").alias("m"))
        open_rows = sized.join(least, "bucket").where(F.col("f") >= threshold * (F.col("n") + F.col("m") - F.col("f")))
        return store.keep(open_rows.select("bucket", "doc_id", "class", "n")), sets

    def add(self, pairs: DataFrame, in_turns: bool = False) -> None:
        """Verify what ``pairs`` can still tell.

        In turns: first each document is held against the likeliest of its partners, then
        against those of the others with which it has no common class by then.
        """
        fresh = self._apart(pairs.join(self.tried, ["a", "b"], "left_anti"))
        self._try(_promising(fresh, self.nodes, self.threshold), in_turns)

    def add_classes(self, pairs: DataFrame) -> None:
        """Pairs of classes that are known to be linked."""
        self.label = _merged(self.store, self.label, self.store.keep(pairs))

    def _try(self, likely: DataFrame, in_turns: bool) -> None:
        store = self.store
        likely = store.keep(likely)
        if likely.isEmpty():
            return
        self.tried = self.tried.union(likely.select("a", "b"))
        asked = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
        asked = small(store.keep(asked.join(self.texts.select("doc_id"), "doc_id", "left_anti")))
        found = only_ids(self.docs, asked, self.id_col)
        found = found.select(F.col(self.id_col).cast("long").alias("doc_id"), text_of(self.text_col).alias("text"))
        self.texts = self.texts.union(store.keep(found.dropDuplicates(["doc_id"])))
        best = F.max_by("b", F.col("share") - F.col("b") / F.lit(1e18))
        for first in (True, False) if in_turns else (False,):
            chosen = likely.groupBy("a").agg(best.alias("b")) if first else self._apart(likely).select("a", "b")
            edges = store.keep(_verified(chosen, self.texts, self.threshold))
            self.label = _merged(store, self.label, edges)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their class, all columns as they were.

    Rows without an id cannot be told apart and all stay.
    """
    near = near_classes(docs, id_col, text_col, **options)
    dropped = near.where("doc_id <> class_id").select("doc_id").distinct()
    return only_ids(docs, small(Stage(docs.sparkSession).keep(dropped)), id_col, "left_anti")
