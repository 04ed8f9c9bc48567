import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, f int, kept string, component_id string, spans string")


def _prose(seed, n):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(n))


def edge_rows():
    """NULLs, blanks, very long texts, ties, repeated rows, clashing columns."""
    base, other = _prose(1, 120), _prose(2, 400)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (3, " ".join(near)), (4, None), (5, ""),
        (6, " \t\n "), (7, "one two"), (8, "One TWO"), (9, "a" * 5000), (10, _prose(3, 20000)),
        (11, _prose(4, 50) + "\n" + base[:260] + "\n" + _prose(5, 50)),
        (12, _prose(6, 60) + " " + other[300:650] + " " + _prose(7, 60)), (13, other),
        (14, "é" * 150 + "è" * 150), (15, "x" + "é" * 150 + "z"), (None, base), (None, None),
        (16, "line\nline\nline\n" * 30), (17, "tail\n\n  spaces  and\ttabs \x00 nul "),
    ]
    return [(d, t, "en" if d != 7 else None, "s", None if t is None else len(t),
             "row", 1, "kept", "c", "spans") for d, t in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
