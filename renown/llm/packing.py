"""Packed training sequences: best fit decreasing with a segment tree over capacities.

Every task packs the documents it reads, a window of tokens at a time, so no token
is shuffled and memory is bounded. Documents longer than a sequence are split into full
sequences and a rest; nothing is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm import bpe
from renown.llm.frames import text_of
from renown.llm.hashing import parts

LENGTH = 2048
WINDOW_TOKENS = 4_000_000

COLUMNS = ("n_tokens", "doc_ids", "starts", "cu_seqlens", "ids", "positions")


def _schema(rows: DataFrame) -> str:
    """Document ids keep the type of ``key``."""
    kind = rows.schema["key"].dataType.simpleString()
    return (
        f"n_tokens int, doc_ids array<{kind}>, starts array<bigint>, cu_seqlens array<int>, "
        "ids binary, positions binary"
    )


class Capacities:
    """Which remaining capacities exist, as a tree of counts over 0 .. length."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, capacity: int, bin_id: int) -> None:
        self.bins[capacity].append(bin_id)
        if len(self.bins[capacity]) == 1:
            self._add(capacity, 1)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """A bin with the smallest capacity that is at least ``size``, with that capacity."""
        at = size + self.leaves
        while not self.count[at]:
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            at += not self.count[at]
        capacity = at - self.leaves
        bin_id = self.bins[capacity].pop()
        if not self.bins[capacity]:
            self._add(capacity, -1)
        return bin_id, capacity


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Numbers of the items in each bin. Sizes are from 1 to ``length``; ties go by number."""
    bins: list[list[int]] = []
    free = Capacities(length)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = free.take_tightest(sizes[item])
        if found is None:
            found = len(bins), length
            bins.append([])
        bin_id, capacity = found
        bins[bin_id].append(item)
        if capacity > sizes[item]:
            free.put(capacity - sizes[item], bin_id)
    return bins


def _window(pieces: list[tuple], length: int, pad: int, key_type: pa.DataType) -> pa.RecordBatch:
    """All sequences of one window, written into one matrix of ids and one of positions."""
    bins = best_fit_decreasing([len(p[2]) for p in pieces], length)
    order = [i for items in bins for i in items]
    sizes = np.array([len(pieces[i][2]) for i in order], np.int64)
    per_bin = np.array([len(items) for items in bins], np.int64)
    cuts = np.append(0, np.cumsum(per_bin))
    ends = np.cumsum(sizes)
    used = np.append(0, ends)[cuts]  # tokens before each sequence
    # place of every token: its segment's place in the matrix, and how far it is into the segment
    within = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    at = np.repeat(ends - sizes - np.repeat(used[:-1] - np.arange(len(bins)) * length, per_bin), sizes) + within
    ids = np.full(len(bins) * length, pad, np.uint32)
    positions = np.zeros(len(bins) * length, np.uint32)
    ids[at] = np.concatenate([pieces[i][2] for i in order])
    positions[at] = within
    lists = pa.array(cuts, pa.int32())
    # cumulative lengths from 0: one number more than segments in each list
    cumulative = np.zeros(len(order) + len(bins), np.int64)
    cumulative[np.arange(len(order)) + np.repeat(np.arange(1, len(bins) + 1), per_bin)] = ends - np.repeat(used[:-1], per_bin)
    width = 4 * length
    rows = np.arange(len(bins) + 1, dtype=np.int64) * width

    def matrix(values: np.ndarray) -> pa.Array:
        offsets = pa.array(rows, pa.int64()).buffers()[1]
        whole = pa.Array.from_buffers(pa.large_binary(), len(bins), [None, offsets, pa.py_buffer(values)])
        return whole.cast(pa.binary())

    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.diff(used), pa.int32()),
            pa.ListArray.from_arrays(lists, pa.array([pieces[i][0] for i in order], key_type)),
            pa.ListArray.from_arrays(lists, pa.array([pieces[i][1] for i in order], pa.int64())),
            pa.ListArray.from_arrays(pa.array(cuts + np.arange(len(bins) + 1), pa.int32()), pa.array(cumulative, pa.int32())),
            matrix(ids),
            matrix(positions),
        ],
        COLUMNS,
    )


def _packed(documents, length: int, pad: int, window_tokens: int, key_type: pa.DataType):
    """Record batches of the sequences of ``(id, ids)``, a window of tokens at a time."""
    pieces, tokens = [], 0
    for key, raw in documents:
        ids = np.frombuffer(raw or b"", np.uint32)
        for at in range(0, len(ids), length):
            pieces.append((key, at, ids[at : at + length]))
            tokens += len(pieces[-1][2])
            if tokens >= window_tokens:
                yield from _slices(_window(pieces, length, pad, key_type))
                pieces, tokens = [], 0
    if pieces:
        yield from _slices(_window(pieces, length, pad, key_type))


def pack(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", length: int = LENGTH, pad: int = 0, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Sequences of ``length`` ids from rows of ids (32 bits each, as :func:`bpe.encode` makes them).

    Per sequence: ``n_tokens`` in use, ``doc_ids`` and ``starts`` (place in the
    document's ids) of its segments, ``cu_seqlens`` (their cumulative lengths from
    0), ``ids`` and ``positions`` (from 0 in each segment), both 32 bits each and
    ``length`` long, with ``pad`` and 0 behind the last segment. Null and empty ids
    have no tokens and no segment. Null ids of documents stay null; repeated rows are
    packed as often as they occur; an empty table gives no rows.
    """

    def run(batches):
        documents = (pair for keys, coded_ids in parts(batches, ("key", "ids"), 64) for pair in zip(keys, coded_ids))
        yield from _packed(documents, length, pad, window_tokens, key_type)

    rows = coded.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    key_type = bpe.arrow_type(rows, "key")
    return rows.mapInArrow(run, _schema(rows))


def pack_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, pad: int = 0, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """``pack`` of the ids of whole texts, encoded and packed by the same task; null and empty texts have no segment."""

    def run(batches):
        encode = bpe.vocabulary(vocabulary_path).encode
        documents = (
            (key, encode(text))
            for keys, texts in parts(batches, ("key", "text"), 64)
            for key, text in zip(keys, texts)
        )
        yield from _packed(documents, length, pad, window_tokens, key_type)

    rows = docs.select(F.col(id_col).alias("key"), text_of(text_col).alias("text"))
    key_type = bpe.arrow_type(rows, "key")
    return rows.mapInArrow(run, _schema(rows))


def _slices(batch: pa.RecordBatch, rows: int = 256):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def write_packed(docs: DataFrame, path: str, vocabulary_path: str, rows: int = 64, **options) -> DataFrame:
    """Write matrices of up to ``rows`` sequences as Parquet files below ``path`` and read them back.

    ``ids`` and ``positions`` are row-major matrices, the other columns lists per row. Repeated rows and
    null ids are packed like any other; documents without tokens are in no matrix, an empty table writes none.
    """
    packed = pack_documents(docs, vocabulary_path, **options)

    names = tuple(packed.columns)

    def run(batches):
        for columns in parts(batches, names, rows):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(columns[0])], pa.int32()),
                    *(pa.array([list(c)], k) for c, k in zip(columns[:4], kinds)),
                    *(pa.array([b"".join(c)], pa.binary()) for c in columns[4:]),
                ],
                ["n_rows", *names],
            )

    key_type = bpe.arrow_type(docs.select(F.col(options.get("id_col", "doc_id")).alias("key")), "key")
    kinds = (
        pa.list_(pa.int32()),
        pa.list_(pa.list_(key_type)),
        pa.list_(pa.list_(pa.int64())),
        pa.list_(pa.list_(pa.int32())),
    )
    schema = (
        f"n_rows int, n_tokens array<int>, doc_ids array<{packed.schema['doc_ids'].dataType.simpleString()}>, "
        "starts array<array<bigint>>, cu_seqlens array<array<int>>, ids binary, positions binary"
    )
    packed.mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)
