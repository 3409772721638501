"""Made-up texts and rows for the tests of the text operators."""

import random

WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, keep_id string, "
    "blob string, h string, item_id string, score string, _wanted_id long, rep string"
)


def rows_of(pairs):
    return [
        (i, t, None, None if k % 2 else "s", None, "x", "x", "x", "x", "x", 1, "x")
        for k, (i, t) in enumerate(pairs)
    ]
