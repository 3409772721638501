"""Log-bilinear language model with noise-contrastive estimation, and smoothed unigram scores.

Tokens are words between blanks, A-Z in lower case, and one end per text. Every word has a
class: the most frequent words one of their own, all others one they share with words of the same ending,
within which a word has its smoothed share of the counts. The number of classes grows with the
square root of the number of distinct words. The model predicts a class from the two classes
before, in two log-bilinear steps: its group (classes of like mass), then the class within
the group. Context vectors, weighted per place, times output vectors plus a bias give the logits of each
step; batched matrix products normalise both exactly at a cost that grows with the
square root of the classes.

Words become classes once, in a table. Training goes over all training rows in rounds: rows
are dealt into shards by a hash, each round trains on its share of the shards, every shard from the same
start, and every parameter row moves to the mean over the shards weighted by how often each used
it. Nothing hangs on how the table is cut into files or partitions.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage, fold, text_of
from renown.llm.hashing import parts, sliced

#: Numbers per vector, an even count.
WIDTH = 24
#: Classes of one word: at least so many, and so many times the square root of the distinct words.
LEAST_CLASSES, CLASSES_PER_ROOT = 1023, 8
#: One shared class for so many of them; words share one if their last bytes have the same hash.
OWN_PER_SHARED, ENDING = 4, 3
#: Words whose counts every task holds; the counts of all others are joined.
TABLE_WORDS = 300_000
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 400_000
#: Tokens of a shard, and rounds that share the shards out.
SHARD_TOKENS, ROUNDS = 2_000_000, 4
#: No word is empty, so this can stand for the end of a text.
END = b""
#: Tokens of a training step; noise groups of a step, noise classes per token.
BATCH, NOISE_GROUPS, NOISE_CLASSES = 8192, 16, 2
#: Tokens that are scored at once, and that one softmax takes, so that its logits stay near the processor.
SCORED, SOFTMAX = 1 << 16, 1024
#: Parameters in a row of the sums.
CHUNK = 4096


def tokens(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split act on A-Z and on space, \\x09 to \\x0D alone."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def count_tokens(rows: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``text``."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for (texts,) in parts(batches, ("text",)):
            for text in texts:
                held.update(tokens(text))
                if len(held) >= HELD_WORDS:
                    yield batch()
                    held.clear()
        yield batch()

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words of the highest counts, at most ``most`` and whole classes of like counts, most frequent first.

    The least count comes from a histogram over eighths of powers of two, so nothing is sorted.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for row in sorted(sizes, reverse=True):
        total += row.n
        if total > most:
            break
        least = row.step
    if least is None:
        return []
    rows = counts.where(step >= least).toArrow()
    pairs = zip(rows.column("word").to_pylist(), rows.column("n").to_pylist())
    return sorted(pairs, key=lambda x: (-x[1], x[0]))


def ending(word: bytes, shared: int) -> int:
    """Which of the shared classes a word without one of its own belongs to."""
    return crc32(word[-ENDING:]) % shared


@dataclass(frozen=True)
class Classes:
    """The class of every word, known or not.

    Classes are numbered by falling mass; ``own`` is the class of words that have one of their own,
    ``shared`` that of each ending, ``mass`` the smoothed count of a class. Groups are ``size`` classes that follow
    each other; ``mass`` is filled up to whole groups with zeros.
    """

    own: dict[bytes, int]
    shared: np.ndarray
    mass: np.ndarray
    size: int

    @property
    def n(self) -> int:
        return int(np.count_nonzero(self.mass))

    @property
    def groups(self) -> int:
        return len(self.mass) // self.size

    @property
    def log_share(self) -> np.ndarray:
        """log10 of the mass of each shared class, 0 where a class is one word."""
        logs = np.zeros(len(self.mass))
        logs[self.shared] = np.log10(self.mass[self.shared])
        return logs

    def of(self, word: bytes) -> int:
        found = self.own.get(word)
        return int(self.shared[ending(word, len(self.shared))]) if found is None else found


def classes(counts: DataFrame, vocabulary: list[tuple[bytes, int]], most: int) -> Classes:
    """Classes for a table of ``word, n``; the first ``most`` of ``vocabulary``, its most frequent words, have their own.

    A shared class has half a count more, for all words that were never seen.
    """
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = [*((w, n) for w, n in vocabulary[:most] if w != END), (END, ends)]
    shared = max(1, len(own) // OWN_PER_SHARED)
    last = F.substring("word", -ENDING, ENDING)
    bucket = F.crc32(F.when(F.octet_length("word") < ENDING, F.col("word")).otherwise(last)) % shared
    sums = counts.groupBy(bucket.cast("int").alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    mass_of = np.full(shared, 0.5)
    for row in sums.collect():  # one row per shared class
        mass_of[row.bucket] += row.n + 0.5 * row.words
    for word, n in own:
        if word != END or n:
            mass_of[ending(word, shared)] -= n + 0.5
    mass = np.concatenate([[n + 0.5 for _, n in own], np.maximum(mass_of, 0.5)])
    order = np.argsort(-mass, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = int(np.ceil(len(mass) ** 0.5))
    filled = np.zeros(-(-len(mass) // size) * size)
    filled[: len(mass)] = mass[order]
    return Classes({w: int(place[k]) for k, (w, _) in enumerate(own)}, place[len(own) :], filled, size)


@dataclass(frozen=True)
class Parameters:
    """Context vectors of all classes (the last row stands before the text), weights per place, and both output layers."""

    vectors: np.ndarray
    places: np.ndarray
    groups: np.ndarray
    group_bias: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @property
    def all(self) -> list[np.ndarray]:
        return [self.vectors, self.places, self.groups, self.group_bias, self.outputs, self.bias]

    @cached_property
    def layers(self) -> tuple[np.ndarray, np.ndarray]:
        """Both output layers, each with its bias as a last column."""
        return np.column_stack([self.groups, self.group_bias]), np.column_stack([self.outputs, self.bias])


def start(c: Classes) -> Parameters:
    """Small random vectors, and biases that give every class its share of the mass."""
    rng = np.random.default_rng(11)
    n, shares = len(c.mass), c.mass / c.mass.sum()
    of_group = shares.reshape(c.groups, c.size).sum(axis=1)
    with np.errstate(divide="ignore"):
        bias = np.log(shares) - np.repeat(np.log(of_group), c.size)
    return Parameters(
        rng.normal(0, 0.1, (n + 1, WIDTH)).astype(np.float32),
        np.ones((2, WIDTH), np.float32),
        rng.normal(0, 0.1, (c.groups, WIDTH)).astype(np.float32),
        np.log(of_group).astype(np.float32),
        rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32),
        np.where(shares > 0, bias, -1e4).astype(np.float32),
    )


def _log_softmax_of(context: np.ndarray, layer: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log probability of one row of ``layer`` for each row of ``context``.

    Logits lie outputs by tokens, so that every pass runs along the tokens.
    """
    logs = np.empty(len(chosen), np.float32)
    for at in range(0, len(chosen), SOFTMAX):
        own = chosen[at : at + SOFTMAX]
        z = layer @ context[at : at + SOFTMAX].T
        z -= z.max(axis=0)
        own = z[own, np.arange(len(own))]
        logs[at : at + SOFTMAX] = own - np.log(np.exp(z, out=z).sum(axis=0))
    return logs


def _context(p: Parameters, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Context vectors, and a one for the bias."""
    context = np.empty((len(near), WIDTH + 1), np.float32)
    context[:, WIDTH] = 1
    vectors = context[:, :WIDTH]
    np.multiply(p.vectors.take(near, axis=0), p.places[0], out=vectors)
    vectors += p.vectors.take(far, axis=0) * p.places[1]
    return context


def log10_probability(p: Parameters, size: int, target: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of each class after its two classes."""
    groups, outputs = p.layers
    out = np.empty(len(target))
    for at in range(0, len(target), SCORED):
        t = target[at : at + SCORED]
        group = t // size
        # tokens of a group lie together, for the step within it
        order = np.argsort(group.astype(np.uint16) if len(groups) < 1 << 16 else group, kind="stable")
        t, group = t[order], group[order]
        context = _context(p, near[at : at + SCORED][order], far[at : at + SCORED][order])
        logs = _log_softmax_of(context, groups, group).astype(np.float64)
        cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(t)]
        for low, high in zip(cuts, cuts[1:]):
            first = int(group[low]) * size
            logs[low:high] += _log_softmax_of(context[low:high], outputs[first : first + size], t[low:high] - first)
        out[at + order] = logs
    return out / np.log(10)


def contexts(ids: list[np.ndarray], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of some texts, and those one and two places before."""
    sizes = np.array([len(i) for i in ids])
    shifted = np.concatenate([[begin, begin], *ids]).astype(np.int64)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(shifted) - 2)
    near = np.where(at - 1 >= first, shifted[1:-1], begin)
    far = np.where(at - 2 >= first, shifted[:-2], begin)
    return shifted[2:], near, far


class Trainer:
    """AdaGrad on the noise-contrastive loss of both steps, from given parameters; counts which rows it uses."""

    def __init__(self, c: Classes, p: Parameters, seed: int, rate: float = 0.05):
        self.c, self.rate = c, np.float32(rate)
        self.values = _joined(p)
        self.squares = [np.full(a.shape, 1e-3, np.float32) for a in self.values]
        self.used = [np.zeros(len(a)) for a in self.values]
        self.rng = np.random.default_rng(seed)
        shares = c.mass / c.mass.sum()
        self.of_group = shares.reshape(c.groups, c.size).sum(axis=1)
        self.up_to = np.cumsum(shares)
        with np.errstate(divide="ignore"):
            in_group = np.log(NOISE_CLASSES * shares / np.repeat(self.of_group, c.size))
        self.log_class, self.log_group = in_group.astype(np.float32), np.log(NOISE_GROUPS * self.of_group).astype(np.float32)

    def _step(self, k: int, rows: np.ndarray, of: np.ndarray, source: np.ndarray, factor: np.ndarray | None, n: int) -> None:
        """One step on the rows that a batch touches: the gradient of ``rows[i]`` is ``source[of[i]]`` times ``factor[i]``."""
        small = rows.astype(np.uint16) if len(self.values[k]) < 1 << 16 else rows
        order = np.argsort(small, kind="stable")
        rows = rows[order]
        at = np.flatnonzero(np.diff(rows, prepend=-1))
        grads = source.take(of[order], axis=0)
        if factor is not None:
            grads *= factor[order][:, None]
        # two numbers are added as one complex number, in half the passes
        grad = np.add.reduceat(grads.view(np.complex64), at, axis=0).view(np.float32)
        grad *= np.float32(1 / np.sqrt(n))
        rows = rows[at]
        self.used[k][rows] += np.diff(np.append(at, len(order)))
        squares = self.squares[k].take(rows, axis=0)
        squares += grad * grad
        self.squares[k][rows] = squares
        grad *= self.rate
        grad /= np.sqrt(squares, out=squares)
        self.values[k][rows] = self.values[k].take(rows, axis=0) - grad

    def learn(self, target: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        vectors, places, groups, outputs = self.values
        n, size = len(target), self.c.size
        each = np.arange(n)
        a, b = vectors.take(near, axis=0), vectors.take(far, axis=0)
        context = np.zeros((n, WIDTH + 2), np.float32)  # and a one for the bias
        np.multiply(a, places[0], out=context[:, :WIDTH])
        context[:, :WIDTH] += b * places[1]
        context[:, WIDTH] = 1

        def error(logits, log_noise, true: int):
            z = np.subtract(log_noise, logits, out=logits)
            np.maximum(z, -30, out=z)
            np.minimum(z, 30, out=z)
            np.exp(z, out=z)
            z += 1
            np.divide(1, z, out=z)
            return np.subtract(z, true, out=z) if true else z

        # the group against noise groups that serve the whole batch
        group = target // size
        noise = self.rng.choice(len(self.of_group), NOISE_GROUPS, p=self.of_group)
        own, others = groups.take(group, axis=0), groups[noise]
        d_own = error(np.einsum("nw,nw->n", context, own), self.log_group[group], 1)
        d_other = error(context @ others.T, self.log_group[noise], 0)
        own *= d_own[:, None]
        d_context = d_other @ others
        d_context += own
        sources = np.concatenate([context, d_other.T @ context])
        factor = np.concatenate([d_own, np.ones(NOISE_GROUPS, np.float32)])
        self._step(2, np.concatenate([group, noise]), np.arange(n + NOISE_GROUPS), sources, factor, n)

        # the class against noise classes of its own group, drawn per token by their mass
        low = np.append(0, self.up_to)[group * size]
        draw = low[:, None] + self.rng.random((n, NOISE_CLASSES)) * self.of_group[group][:, None]
        drawn = np.minimum(np.searchsorted(self.up_to, draw, "right"), self.c.n - 1)
        drawn = np.clip(drawn, group[:, None] * size, group[:, None] * size + size - 1)
        own = outputs.take(target, axis=0)
        d_own = error(np.einsum("nw,nw->n", context, own), self.log_class[target], 1)
        own *= d_own[:, None]
        d_context += own
        factors = [d_own]
        for j in range(NOISE_CLASSES):
            other = outputs.take(drawn[:, j], axis=0)
            d_other = error(np.einsum("nw,nw->n", context, other), self.log_class[drawn[:, j]], 0)
            other *= d_other[:, None]
            d_context += other
            factors.append(d_other)
        rows = np.concatenate([target, *drawn.T])
        self._step(3, rows, np.tile(each, NOISE_CLASSES + 1), context, np.concatenate(factors), n)

        d_context = d_context[:, :WIDTH]
        sources = np.concatenate([d_context * places[0], d_context * places[1]])
        both = np.stack([np.einsum("nw,nw->w", d_context, a), np.einsum("nw,nw->w", d_context, b)]) / np.float32(np.sqrt(n))
        self._step(0, np.concatenate([near, far]), np.arange(2 * n), sources, None, n)
        self._step(1, np.arange(2), np.arange(2), both, None, n)

    def weighted(self) -> np.ndarray:
        """All parameters times how often their row was used, then these numbers."""
        return np.concatenate([(v * u[:, None]).ravel() for v, u in zip(self.values, self.used)] + self.used)


def _joined(p: Parameters) -> list[np.ndarray]:
    """Copies of the parameters, each output layer with its bias and a zero, which stays one, as last columns."""
    layers = [np.pad(layer, ((0, 0), (0, 1))) for layer in p.layers]
    return [p.vectors.copy(), p.places.copy(), *layers]


def _mean(p: Parameters, sums: np.ndarray) -> Parameters:
    """Rows that were used move to their mean, all others stay."""
    old = _joined(p)
    cuts = np.cumsum([a.size for a in old] + [len(a) for a in old])[:-1]
    pieces = np.split(sums, cuts)
    new = []
    for values, total, used in zip(old, pieces[: len(old)], pieces[len(old) :]):
        mean = total.reshape(values.shape) / np.maximum(used, 1)[:, None]
        new.append(np.where(used[:, None] > 0, mean, values).astype(np.float32))
    vectors, places, groups, outputs = new
    return Parameters(vectors, places, groups[:, :WIDTH], groups[:, WIDTH], outputs[:, :WIDTH], outputs[:, WIDTH])


def train(coded: DataFrame, c: Classes, total: int, store: Stage, rounds: int = ROUNDS) -> Parameters:
    """One pass over the ``classes`` of all rows, in ``rounds`` averaged rounds.

    Shards are a hash of a row's id and classes, and rows come in the order of another, so equal tables
    give equal shards whatever their partitions. The sums of a round have one row per ``CHUNK``
    parameters and task, and the driver gets as many numbers as the model has.
    """
    p = start(c)
    if not total:
        return p
    spark = coded.sparkSession
    shards = rounds * -(-total // (rounds * SHARD_TOKENS))
    draw = F.xxhash64("doc_id", "classes")
    dealt = coded.select(F.pmod(draw, F.lit(shards)).cast("int").alias("shard"), F.xxhash64(draw).alias("draw"), "classes")
    dealt = dealt.withColumn("round", F.col("shard") % rounds).repartition("shard")
    dealt = store.keep(dealt.sortWithinPartitions("round", "shard", "draw", "classes"), partition_by="round")
    c = replace(c, own={})  # tasks get classes, not words
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(p)

        def run(batches):
            begin, sums, trainer, shard, held, size = len(c.mass), None, None, None, [], 0

            def learn():
                flat = contexts(held, begin)
                order = trainer.rng.permutation(size)
                for at in range(0, size, BATCH):
                    trainer.learn(*(x[order[at : at + BATCH]] for x in flat))

            for numbers, packed in parts(batches, ("shard", "classes")):
                for number, ids in zip(numbers, packed):
                    if number != shard or size >= 8 * BATCH:
                        if size:
                            learn()
                            held, size = [], 0
                        if number != shard:
                            if trainer is not None:
                                sums = trainer.weighted() if sums is None else sums + trainer.weighted()
                            shard, trainer = number, Trainer(c, shared.value, number)
                    held.append(np.frombuffer(ids, np.uint32))
                    size += len(held[-1])
            if trainer is None:
                return
            if size:
                learn()
            sums = trainer.weighted() if sums is None else sums + trainer.weighted()
            for at in range(0, len(sums), CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([sums[at : at + CHUNK].tobytes()], pa.binary())], ["at", "sums"]
                )

        def add(table: pa.Table) -> pa.Table:
            added = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
            return pa.table({"at": table.column("at")[:1], "sums": pa.array([added.tobytes()], pa.binary())})

        each = dealt.where(F.col("round") == turn).select("shard", "classes").mapInArrow(run, "at long, sums binary")
        rows = each.groupBy("at").applyInArrow(add, "at long, sums binary").collect()
        if rows:
            p = _mean(p, np.concatenate([np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.at)]))
        shared.unpersist()
    return p


@dataclass(frozen=True)
class Words:
    """What every task knows of the words: the classes of all, and of the frequent ones a number each, under which
    their class and log10(count + 0.5) are found."""

    classes: Classes
    numbers: dict[bytes, int]
    class_of: np.ndarray
    logs: np.ndarray

    @staticmethod
    def of(c: Classes, vocabulary: list[tuple[bytes, int]]) -> Words:
        counts = dict(vocabulary)
        counts.setdefault(END, c.mass[c.own[END]] - 0.5)
        return Words(
            c,
            {w: k for k, w in enumerate(counts)},
            np.array([c.of(w) for w in counts], np.uint32),
            np.log10(np.array(list(counts.values()), float) + 0.5),
        )


def _coded(rows: DataFrame, words: Words) -> DataFrame:
    """Every row with the classes of its tokens, what the words all tasks hold give to it, and its other words."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(words)

    def run(batches):
        w = shared.value
        get, unknown = w.numbers.get, repeat(-1)
        alone = np.ones(len(w.classes.mass), bool)
        alone[w.classes.shared] = False
        n = TaskContext.get().partitionId() << 33
        for some in sliced(batches, 256):
            out = [[] for _ in range(6)]
            for text in some.column("text").to_pylist():
                words = tokens(text)
                numbers = np.fromiter(map(get, words, unknown), np.int64, len(words))
                ids, logs = w.class_of[numbers], w.logs[numbers]
                missing = np.flatnonzero(numbers < 0)
                others = [words[k] for k in missing.tolist()]
                ids[missing] = [w.classes.of(word) for word in others]
                logs[missing] = 0
                times = Counter(others)
                row = (
                    len(words),
                    len(words) - len(others),
                    logs.sum(),
                    logs[~alone[ids]].sum(),
                    ids.tobytes(),
                    [{"word": x, "times": k} for x, k in times.items()],
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(n, n + some.num_rows), pa.int64()),
                    some.column("doc_id"),
                    some.column("held_out"),
                    *(pa.array(column, kind) for column, kind in zip(out, kinds)),
                ],
                names,
            )
            n += some.num_rows

    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
    kinds.append(pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))
    schema = (
        f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "base double, shared double, classes binary, others array<struct<word: binary, times: bigint>>"
    )
    names = [c.split(" ")[0] for c in schema.split(", ")][:9]
    return rows.mapInArrow(run, schema)


def _modelled(coded: DataFrame, c: Classes, p: Parameters) -> DataFrame:
    """The rows with ``model``: the log10 probability of their classes less the mass of shared ones."""
    shared = coded.sparkSession.sparkContext.broadcast((p, c.size, c.log_share))
    kept = [x for x in coded.columns if x not in ("classes", "others")]
    begin = len(c.mass)

    def run(batches):
        params, size, log_share = shared.value
        for some in sliced(batches, 256):
            ids = [np.frombuffer(x, np.uint32) for x in some.column("classes").to_pylist()]
            sizes = [len(i) for i in ids]
            flat, near, far = contexts(ids, begin)
            logs = log10_probability(params, size, flat, near, far) - log_share[flat]
            model = np.bincount(np.repeat(np.arange(len(ids)), sizes), logs, len(ids))
            yield pa.RecordBatch.from_arrays([some.column(k) for k in kept] + [pa.array(model)], [*kept, "model"])

    kinds = ", ".join(f"{x} {coded.schema[x].dataType.simpleString()}" for x in kept)
    return coded.select(*kept, "classes").mapInArrow(run, f"{kinds}, model double")


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_words: int = TABLE_WORDS,
    least_classes: int = LEAST_CLASSES,
    classes_per_root: float = CLASSES_PER_ROOT,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Training rows are those whose crc32(id) mod 5 is not 1. ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, ``score`` is the model's log10
    probability of the whole text with its end. Null and empty texts are
    one end token. Ids keep their type. Rows stay as they are, repeated or with null ids; without training rows
    N and V are 0 and only the end and one class for all words are there. An empty table gives no rows.
    """
    store = Stage(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (fold(id_col, 5) == 1).alias("held_out"), text_of(text_col).alias("text")
    )
    learned = rows.where(~F.col("held_out")).select("text")
    counts = store.keep(count_tokens(learned))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    most = max(least_classes, int(classes_per_root * distinct**0.5))
    vocabulary = frequent(counts, max(table_words, most))
    c = classes(counts, vocabulary, most)
    # all words with a class of their own are among those that every task knows
    coded = store.keep(_coded(rows, Words.of(c, vocabulary)))
    p = train(coded.where(~F.col("held_out")), c, total, store)
    store.clear(counts, coded)
    known = _modelled(coded, c, p)
    other = coded.select("row", F.inline("others"))
    told = other.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("other"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("found"),
    )
    every = known.join(told, "row", "left")
    other = F.coalesce("other", F.lit(0.0))
    unit = float(np.log10(total + 0.5 * (distinct + 1)))
    return every.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0)) if total else F.lit(0).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + other - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model") + F.col("shared") + other).alias("score"),
    )
