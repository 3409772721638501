import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from helpers import SCHEMA, prose, rows_of  # noqa: E402


@pytest.fixture(scope="session")
def edge_pairs():
    """Nulls, empties, blanks, ties, repeated rows, other scripts and one long text."""
    same = prose(1, 300)
    return [
        (5, same),
        (3, same),
        (7, same.replace(" ", "\n ")),
        (8, same + "  "),
        (8, same + "  "),
        (10, None),
        (11, ""),
        (12, " \t\n"),
        (13, "ééé 中文   emoji 😀 text"),
        (14, "one two"),
        (15, prose(2, 60_000)),
        (None, "no id here at all"),
        (None, None),
        (16, prose(3, 40)),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_pairs):
    """The pairs with null columns and columns whose names clash with inner ones."""
    return spark.createDataFrame(rows_of(edge_pairs), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
