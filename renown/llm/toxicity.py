"""Toxicity scores by a factorization machine over hashed terms.

Terms are words and the beginnings of words, hashed to ``2 ** BITS`` buckets, and
whether a text has them once, twice or three times. Besides a weight each bucket has a short vector; the product of two vectors is
the weight of their meeting in one text, which a sum of single weights cannot learn.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage, bounded_rows, fold, text_of
from renown.llm.hashing import Sums, U, blocks, forget_others, parts

BITS = 20
#: Bytes of a word that count as its beginning.
BEGINNINGS = (4, 5, 6, 7)
#: A term gives a feature for each number of times up to this.
TIMES = 3
REJECTED = 0.7


def term_buckets(texts: list[str | None]):
    """Text numbers and buckets of all terms, block by block; a text may run on in the next block."""
    for raw, owner, start, end in blocks(texts):
        sums = Sums(raw)
        found = [(owner, sums.hash(start, end))]
        for n in BEGINNINGS:
            long = end - start >= n
            found.append((owner[long], sums.hash(start[long], start[long] + n) ^ U(n)))
        yield (
            np.concatenate([o for o, _ in found]),
            (np.concatenate([h for _, h in found]) >> U(64 - BITS)).astype(np.int64),
        )


def features(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and features (bucket times ``TIMES``, plus times less one), of ``wanted`` buckets only if given."""
    pairs = [np.zeros(0, np.int64)]
    for owner, bucket in term_buckets(texts):
        if wanted is not None:
            hit = wanted[bucket]
            owner, bucket = owner[hit], bucket[hit]
        pairs.append(owner << BITS | bucket)
    pair, count = np.unique(np.concatenate(pairs), return_counts=True)
    count = np.minimum(count, TIMES)
    each = np.repeat(pair, count)
    times = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    return each >> BITS, (each & ((1 << BITS) - 1)) * TIMES + times


@dataclass(frozen=True)
class FactorizationMachine:
    terms: np.ndarray  # the features that have weights, in order
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of the label for each text; a text without known terms has that of the bias."""
        wanted = np.zeros(1 << BITS, bool)
        wanted[self.terms // TIMES] = True
        owner, feature = features(texts, wanted)
        term = np.searchsorted(self.terms, feature)
        known = np.append(self.terms, -1)[term] == feature
        owner, term = owner[known], term[known]
        n = len(texts)
        linear = np.bincount(owner, self.weights[term], n)
        pairwise = np.zeros(n)
        for v in self.vectors.T:
            pairwise += np.bincount(owner, v[term], n) ** 2 - np.bincount(owner, v[term] ** 2, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairwise / 2, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, terms: np.ndarray, factors: int = 8, epochs: int = 40) -> FactorizationMachine:
    """Logistic loss, AdaGrad steps on mini-batches; ``x`` is 0/1 (rows by terms), seeds are fixed."""
    rng = np.random.default_rng(7)
    n, k = x.shape
    rate = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    bias, w = np.log(rate / (1 - rate)), np.zeros(k)
    v = rng.normal(0, 0.02, (k, factors))
    gb, gw, gv = 1e-6, np.full(k, 1e-6), np.full((k, factors), 1e-6)
    for _ in range(epochs if n and k else 0):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            xb = x[rows].astype(np.float64)
            s = xb @ v
            z = bias + xb @ w + 0.5 * (s**2 - xb @ v**2).sum(1)
            err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]
            dw = xb.T @ err / len(rows) + 1e-5 * w
            dv = (xb.T @ (err[:, None] * s) - (xb.T @ err)[:, None] * v) / len(rows) + 1e-5 * v
            db = err.mean()
            gb, gw, gv = gb + db**2, gw + dw**2, gv + dv**2
            bias -= 0.1 * db / np.sqrt(gb)
            w -= 0.1 * dw / np.sqrt(gw)
            v -= 0.02 * dv / np.sqrt(gv)
    return FactorizationMachine(terms, float(bias), w, v)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 20_000,
    max_terms: int = 2048,
) -> FactorizationMachine:
    """Learn ``label_col`` from the rows whose crc32(id) mod 3 is not 1.

    Documented bounds: at most ``max_rows`` rows of as many labelled ids, those with the
    smallest hashes, equal rows counted once, and the ``max_terms`` terms that part the classes
    best. Rows without label or id teach nothing. Labels given twice for an id count
    as the larger. Without labels the model gives every text 0.5.
    """
    store = Stage(docs.sparkSession)
    told = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, 3) != 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    )
    told = told.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    told = F.broadcast(store.keep(told))  # at most max_rows rows
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text")).join(told, "_id")
    rows = bounded_rows(rows, max_rows)

    def found_terms(batches):
        forget_others()
        for ids, texts, ys in parts(batches, ("_id", "text", "y"), 128):
            owner, feature = features(texts)
            found = np.split(feature, np.searchsorted(owner, np.arange(1, len(texts))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                ["y", "terms"],
            )

    seen = store.keep(rows.mapInArrow(found_terms, "y int, terms array<int>"))
    n, positive = seen.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n:
        return FactorizationMachine(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, 1)))
    counts = seen.select("y", F.explode("terms").alias("term")).groupBy("term")
    counts = counts.agg(F.sum("y").alias("a"), (F.count("*") - F.sum("y")).alias("b"))
    share = F.col("a") / F.lit(max(1, positive)), F.col("b") / F.lit(max(1, n - positive))
    # a z-score of the two shares, smoothed so that rare terms need a clear lead
    spread = F.sqrt((F.col("a") + F.col("b") + 2) / F.lit(float(n)))
    chosen = counts.where("a + b >= 2").select("term", (F.abs(share[0] - share[1]) / spread).alias("z"))
    terms = sorted(r.term for r in chosen.orderBy(F.desc("z"), "term").limit(max_terms).collect())
    wanted = F.array(*map(F.lit, terms)).cast("array<int>")
    sample = seen.select("y", F.array_intersect("terms", wanted).alias("terms")).toPandas()
    store.clear()
    x = np.zeros((len(sample), len(terms)), np.uint8)
    for i, terms_of in enumerate(sample["terms"]):
        x[i, np.searchsorted(terms, terms_of)] = 1
    order = np.lexsort((*x.T[:16], x.sum(1), sample["y"]))  # the same order whatever the partitions
    return train(x[order], sample["y"].to_numpy(float)[order], np.array(terms, np.int64))


def score_column(model: FactorizationMachine, text_col: str = "text"):
    """The score of each row's whole text as a column."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        forget_others()
        some = [model.scores(texts.slice(at, 256).to_pylist()) for at in range(0, len(texts), 256)]
        return pa.array(np.concatenate(some) if some else np.zeros(0), pa.float64())

    return score(text_of(text_col))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``.

    ``score`` is the probability of the label for the whole text, null and
    empty texts included; ``predicted`` is 1 from 0.7 on. Repeated rows stay
    repeated, null ids stay null, an empty table gives no rows. Other columns are not read.
    """
    model = fit(docs, labels, id_col, text_col, **fit_options)
    scored = docs.select(F.col(id_col), (fold(id_col, 3) == 1).alias("held_out"), score_column(model, text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECTED).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.7, all columns as they were."""
    model = fit(docs, labels, id_col, text_col, **fit_options)
    return docs.where(score_column(model, text_col) < REJECTED)
