"""Byte-level BPE encoding and decoding over a public vocabulary file.

A text is cut at the added tokens and then by the file's word pattern. A word
is encoded on a contiguous rank array: its parts, and for each two neighbours the rank of
their merge. The smallest rank is found by a scan, the boundary there deleted
and the two ranks beside it refreshed. Words above ``SHORT`` bytes, for which scans
would be quadratic, take the same merges from a heap over linked parts.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import text_of
from renown.llm.hashing import parts, remembers

#: Fixed value: the word pattern of the vocabulary file's pre-tokenizer, with the
#: commonest branch first (no text fits two of them at one place).
PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII, where the standard library's matcher is twice as fast.
ASCII_PATTERN = PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^\\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
SHORT = 128
#: Words a worker remembers with their ids by default, some 150 bytes each; beyond it starts afresh.
REMEMBERED = 800_000
NONE = 1 << 30


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the file: itself if printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Vocabulary(dict):
    """Ids (little-endian, 32 bits each) by word; what is missing is encoded on demand."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__()
        self.remembered = remembered
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        ids, letters = file["model"]["vocab"], byte_letters()
        self.of_byte = [ids[letters[b]] for b in range(256)]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for pair in file["model"]["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(ids[left] << 32 | ids[right], len(self.made))
            self.made.append(ids[left + right])
        pairs_of_bytes = (a << 32 | b for a in self.of_byte for b in self.of_byte)
        self.first_ranks = [self.rank.get(p, NONE) for p in pairs_of_bytes]
        bytes_of = {c: b for b, c in letters.items()}
        self.bytes_of = {i: bytes(map(bytes_of.__getitem__, t)) for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.any_words = regex.compile(PATTERN).findall
        self.ascii_words = re.compile(ASCII_PATTERN, re.ASCII).findall
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        ids = self._short(raw) if len(raw) <= SHORT else self._long(raw)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= SHORT:
            if len(self) >= self.remembered:
                self.clear()
            self[word] = packed
        return packed

    def _short(self, raw: bytes) -> list[int]:
        rank, made = self.rank.get, self.made
        ids = list(map(self.of_byte.__getitem__, raw))
        first = self.first_ranks
        ranks = [first[a << 8 | b] for a, b in zip(raw, raw[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            ids[i] = new = made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | new, NONE)
            if i < len(ranks):
                ranks[i] = rank(new << 32 | ids[i + 1], NONE)
        return ids

    def _long(self, raw: bytes) -> list[int]:
        rank, made, n = self.rank.get, self.made, len(raw)
        ids = [self.of_byte[b] for b in raw]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << 32 | ids[j], NONE) != r:
                continue
            ids[i], ids[j], after[i] = made[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank(ids[a] << 32 | ids[b], NONE)) != NONE:
                    heapq.heappush(heap, (r, a))
        return [i for i in ids if i >= 0]

    def words(self, text: str) -> list[str]:
        return self.ascii_words(text) if text.isascii() else self.any_words(text)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cut is None or not any(t in text for t in self.added):
            return b"".join(map(self.__getitem__, self.words(text)))
        return b"".join(
            self.added[part].to_bytes(4, "little")
            if part in self.added
            else b"".join(map(self.__getitem__, self.words(part)))
            for part in self.cut.split(text)
        )

    def decode(self, packed: bytes | None) -> str:
        ids = memoryview(packed or b"").cast("I")
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str, remembered: int = REMEMBERED) -> Vocabulary:
    """One per worker process."""
    remembers("bpe", vocabulary.cache_clear)
    return Vocabulary(path, remembered)


def encode(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """``id_col, ids`` for every row: the token ids as little-endian unsigned 32-bit integers.

    Null and empty texts have empty ids, added tokens in a text become their
    ids, rows with a repeated or null id stay separate rows, other columns are
    not read, an empty table gives no rows. ``vocabulary_path`` must be readable on every executor.
    A worker remembers the ids of ``remembered`` words, which costs memory and saves time alone.
    """

    def run(batches):
        v = vocabulary(vocabulary_path, remembered)
        for keys, texts in parts(batches, ("key", "text")):
            packed = pa.array([v.encode(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), packed], ["key", "ids"])

    rows = docs.select(F.col(id_col).alias("key"), text_of(text_col).alias("text"))
    key_type = arrow_type(rows, "key")
    made = rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, ids binary")
    return made.withColumnRenamed("key", id_col)


def decode(coded: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, text``: the text of each row's ids, which :func:`encode` made.

    Null ids are empty text, repeated rows stay rows of their own, an empty table gives no rows.
    """

    def run(batches):
        v = vocabulary(vocabulary_path)
        for keys, ids in parts(batches, ("key", "ids")):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, key_type),
                    pa.array(ids, pa.binary()),
                    pa.array([v.decode(i) for i in ids], pa.string()),
                ],
                ["key", "ids", "text"],
            )

    rows = coded.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    key_type = arrow_type(rows, "key")
    made = rows.mapInArrow(
        run, f"key {rows.schema['key'].dataType.simpleString()}, ids binary, text string"
    )
    return made.withColumnRenamed("key", id_col)


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)
