"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a public vocabulary, in lower case; each language has its own
probability for each. The probability of a word is the sum over all ways to cut it into
pieces, by the forward algorithm; that of a text is the product over its words. A word is a run of
letters, however long: scripts without blanks have whole sentences as words. The piece
probabilities come from expectation maximisation over the same sums; there alone, long runs are cut into
stretches between characters.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage, bounded_rows, fold, text_of
from renown.llm.hashing import LETTERS, Sums, U, blocks, parts

#: Bytes up to which words of one length are worked out together; longer ones go one by one.
WORD = 32
#: Sums below this are scaled up on the way through a long word.
TINY = 1e-150
REMEMBERED = 400_000
UNKNOWN = "und"


def read_pieces(path: str) -> list[bytes]:
    """Pieces of letters in lower case, with or without a leading space, in the order of the file."""
    with open(path, "rb") as f:
        pieces = [lowered(base64.b64decode(line.split()[0])) for line in f if line.strip()]
    plain = [p for p in pieces if p and all(LETTERS[b] for b in p.removeprefix(b" "))]
    single = [b" ", *(bytes([b]) for b in np.flatnonzero(LETTERS))]
    return list(dict.fromkeys(plain + single))


def lowered(piece: bytes) -> bytes:
    """In lower case; a piece that cuts a character has its ASCII letters lowered."""
    try:
        return piece.decode("utf-8").lower().encode("utf-8")
    except UnicodeDecodeError:
        return piece.lower()


class Lattice:
    """Looks up which stretches of words are pieces."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.lengths = sorted({len(p) for p in pieces})
        ends = np.cumsum([len(p) for p in pieces])
        h = Sums(np.frombuffer(b"".join(pieces), np.uint8)).hash(ends - [len(p) for p in pieces], ends)
        self.order = np.argsort(h)
        self.sorted = h[self.order]

    def grid(self, words: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For words of one length (rows of bytes): the piece from i to j, or ``n`` for none."""
        n, length = words.shape
        sums = Sums(words.reshape(-1))
        base = np.arange(n) * length
        found = {}
        for i in range(length):
            for size in self.lengths:
                j = i + size
                if j > length:
                    break
                piece = self._piece(sums.hash(base + i, base + j))
                if (piece < self.n).any():
                    found[i, j] = piece
        return found

    def _piece(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, h), self.n - 1)
        return np.where(self.sorted[at] == h, self.order[at], self.n)

    def ending_at(self, word: np.ndarray) -> np.ndarray:
        """For one word: per piece length and place, the piece of that length that ends there, or ``n``."""
        sums, n = Sums(word), len(word)
        ending = np.full((len(self.lengths), n + 1), self.n)
        for k, size in enumerate(self.lengths):
            if size <= n:
                first = np.arange(n - size + 1)
                ending[k, size:] = self._piece(sums.hash(first, first + size))
        return ending


def forward(grid, p: np.ndarray, n: int, length: int) -> np.ndarray:
    """Sums over the segmentations of each prefix; ``p`` has a row per piece and a last row of zeros."""
    alpha = np.zeros((length + 1, n, p.shape[1]))
    alpha[0] = 1
    for (i, j), piece in sorted(grid.items(), key=lambda x: x[0][1]):
        alpha[j] += alpha[i] * p[piece]
    return alpha


def forward_long(lattice: Lattice, word: bytes, p: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations of one word of any length, per language.

    Only the sums that a piece can still begin at are kept, scaled up when they get small.
    """
    ending = lattice.ending_at(np.frombuffer(word, np.uint8))
    lengths = np.array(lattice.lengths)
    reach = int(lengths[-1])
    alpha, scale = np.zeros((reach, p.shape[1])), np.zeros(p.shape[1])  # place i is row i modulo reach
    alpha[0] = 1
    for j in range(1, len(word) + 1):
        hit = np.flatnonzero(ending[:, j] < lattice.n)
        row = (alpha[(j - lengths[hit]) % reach] * p[ending[hit, j]]).sum(axis=0)
        alpha[j % reach] = row
        if j % 16 == 0:
            top = alpha.max(axis=0)
            small = (top < TINY) & (top > 0)
            if small.any():
                alpha[:, small] /= top[small]
                scale[small] += np.log(top[small])
    return np.log(np.maximum(alpha[len(word) % reach], 1e-300)) + scale


def expected(grid, p: np.ndarray, weight: np.ndarray, length: int, total: np.ndarray) -> None:
    """Add the expected counts of the pieces; ``weight`` has a row per word, a column per language."""
    n = len(weight)
    alpha = forward(grid, p, n, length)
    beta = np.zeros_like(alpha)
    beta[length] = weight / np.maximum(alpha[length], 1e-300)
    for (i, j), piece in sorted(grid.items(), key=lambda x: -x[0][0]):
        part = p[piece] * beta[j]
        beta[i] += part
        np.add.at(total, piece, alpha[i] * part)


def by_length(words: list[bytes]):
    """Places and byte rows of the words of each length, each with a space before it."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        raw = np.frombuffer(b"".join(b" " + words[i] for i in at), np.uint8)
        yield at, raw.reshape(len(at), size + 1)


def words_in(texts: list[str | None]):
    """Per block: text number, hash and a getter of the bytes of each word."""
    for raw, owner, start, end in blocks(texts, LETTERS):
        data = raw.tobytes()
        yield owner, Sums(raw).hash(start, end), lambda k, s=start, e=end, d=data: d[s[k] : e[k]]


def stretches(word: bytes) -> list[bytes]:
    """A word in parts of ``WORD`` bytes at most, cut between characters."""
    found = []
    while len(word) > WORD:
        cut = WORD
        while cut > 1 and word[cut] & 0xC0 == 0x80:
            cut -= 1
        found.append(word[:cut])
        word = word[cut:]
    return [*found, word]


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[bytes]
    p: np.ndarray  # pieces + 1 rows

    def __getstate__(self):
        return {"languages": self.languages, "pieces": self.pieces, "p": self.p}

    @cached_property
    def _lattice(self) -> Lattice:
        return Lattice(self.pieces)

    @cached_property
    def _known(self) -> dict[int, int]:
        self._logs = np.zeros((REMEMBERED + 1, len(self.languages)))
        return {}

    def _learn(self, hashes: list[int], words: list[bytes]) -> None:
        base = len(self._known)
        long = [i for i, w in enumerate(words) if len(w) > WORD]
        for i in long:
            self._logs[base + i] = forward_long(self._lattice, b" " + words[i], self.p)
        short = np.setdiff1d(np.arange(len(words)), long)
        for at, rows in by_length([words[i] for i in short]):
            grid = self._lattice.grid(rows)
            sums = forward(grid, self.p, len(at), rows.shape[1])[-1]
            self._logs[base + short[at]] = np.log(np.maximum(sums, 1e-300))
        self._known.update(zip(hashes, range(base, base + len(words))))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Log probability of each text's words in each language."""
        total = np.zeros((len(texts), len(self.languages)))
        known = self._known
        for owner, h, get in words_in(texts):
            unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            ids = unique.tolist()
            if len(known) + len(ids) > REMEMBERED:
                known.clear()
            for at in range(0, len(ids), REMEMBERED):  # one round but for immense blocks
                some = slice(at, at + REMEMBERED)
                new = [(x, int(f)) for x, f in zip(ids[some], first[some]) if x not in known]
                self._learn([x for x, _ in new], [get(f) for _, f in new])
            logs = self._logs[[known[x] for x in ids]]
            for k in range(logs.shape[1]):
                total[:, k] += np.bincount(owner, logs[inverse, k], len(texts))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, sure = [], []
        logs = self.scores(texts)
        for text, row in zip(texts, logs):
            if not self.languages or not any(map(str.isalpha, text or "")):
                names.append(UNKNOWN)
                sure.append(0.0)
                continue
            best = int(row.argmax())
            names.append(self.languages[best])
            sure.append(float(1 / np.exp(np.minimum(row - row[best], 0)).sum()))
        return names, sure


def fit(
    docs: DataFrame,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = 20_000,
    rounds: int = 3,
) -> LanguageModel:
    """Learn from rows with a language and an id whose crc32(id) mod 5 is not 0.

    Documented bound: at most ``max_docs`` rows, those with the smallest hash of id, language and text; equal
    rows count once. An empty language is a language. Each round is one distributed pass over the distinct words of each language.
    """
    store = Stage(docs.sparkSession)
    pieces = read_pieces(pieces_path)
    able = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & (fold(id_col, 5) != 0))
    rows = able.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    rows = bounded_rows(rows, max_docs).select("lang", "text")

    def count(batches):
        for langs, texts in parts(batches, ("lang", "text")):
            counts: dict[tuple[str, bytes], int] = {}
            for owner, _, get in words_in(texts):
                for k, o in enumerate(owner.tolist()):
                    for word in stretches(get(k)):
                        key = langs[o], word
                        counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.string()),
                    pa.array([k[1] for k in counts], pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    words = rows.mapInArrow(count, "lang string, word binary, n long")
    words = store.keep(words.groupBy("word", "lang").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    p = np.full((len(pieces) + 1, len(languages)), 1 / len(pieces))
    p[-1] = 0
    for _ in range(rounds if languages else 0):
        p = _round(words, languages, pieces, p)
    store.clear()
    return LanguageModel(languages, pieces, p)


def _round(words: DataFrame, languages: list[str], pieces: list[bytes], p: np.ndarray) -> np.ndarray:
    def run(batches):
        lattice, total = Lattice(pieces), np.zeros(p.shape)
        place = {name: k for k, name in enumerate(languages)}
        for langs, some, counts in parts(batches, ("lang", "word", "n"), 20_000):
            weight = np.zeros((len(some), len(languages)))
            weight[np.arange(len(some)), [place[x] for x in langs]] = counts
            for at, rows in by_length(some):
                expected(lattice.grid(rows), p, weight[at], rows.shape[1], total)
        piece, lang = np.nonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])],
            ["piece", "lang", "n"],
        )

    parts_of = words.mapInArrow(run, "piece int, lang int, n double")
    sums = parts_of.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    q = np.full(p.shape, 0.01)
    q[sums["piece"], sums["lang"]] += sums["n"]
    q[-1] = 0
    return q / q.sum(0)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` for every row, from its whole text alone.

    ``score`` is the share of the predicted language among all; equal
    languages go by name. A text that is null or has no letter is ``und`` with
    score 0, as is any text if nothing was learned. Rows stay as they are, repeated or with
    null ids; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd

        every, names, sure = texts.tolist(), [], []
        for at in range(0, len(every), 512):
            some = shared.value.predict(every[at : at + 512])
            names += some[0]
            sure += some[1]
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(sure, dtype="float64")})

    told = docs.select(F.col(id_col), (fold(id_col, 5) == 0).alias("held_out"), predict(text_of(text_col)).alias("p"))
    return told.select(id_col, "held_out", "p.lang_pred", "p.score")
