import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import documents  # noqa: E402

#: Names that operators use for themselves.
CLASHING = "key long, twin string, node string, start string, n int, label int, line string, row int"


@pytest.fixture(scope="session")
def edges():
    """Rows (doc_id, text): nulls, empty and long texts, rows that repeat, ties, odd characters."""
    rng = random.Random(3)
    rows = documents()[:40]
    long = " ".join(rng.choice(["la", "le", "thing", "ñandú", "<*>"]) for _ in range(20_000))
    shared = rows[3][1][:900]
    return [
        *rows,
        (500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "one two"), (505, "One TWO"),
        (506, long), (507, long + " end"), (508, "x" * 3000), (509, "ab" * 400), (510, "é" * 250),
        (511, "start " + shared + " end"), (512, "other " + shared), (513, shared[50:700]),
        (514, "call +1 (521) 555-6210 or a.b@c.de, 10.0.0.1; 4111 1111 1111 1111"),
        (515, "\x1c \x85   null\x00byte"), (600, rows[5][1]), (600, rows[5][1]),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edges):
    """The rows, one without doc_id, with further columns whose names clash with inner ones."""
    rows = [(*row, 1, "t", "n", "s", 2, 3, "l", 4) for row in [*edges, (None, "no id"), (None, None)]]
    schema = f"doc_id long, text string, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")
