import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = ("word " * 30_000).strip() + " end@mail.example.com password=0123456789abcdef"
TEXTS = [
    None,
    "",
    " \t\n\x0b",
    "a",
    "Same words Here again and again",
    "same words here again and again",
    "é😀 x@y.zz 10.0.0.1 or +1 (555) 123-4567, 4111 1111 1111 1111 secret: abcdefghij",
    "\n".join(["one line of some words", "another line of other words", "one line of some words"] * 20),
    LONG,
    "x" * 50_000,
    "1" * 5_000 + " " + "a" * 5_000 + "@" + "b." * 3_000 + "c",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rank int, _verdict string, _id int, _hash int, _terms int, topic string, fp int, id int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, ties, repeated rows, very long texts and clashing extra columns."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", i, i, "v", i, i, i, "t", i, i) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[6], rows[6]]
    rows += [(None, "Same words here again and again", None, None, None, None, None, None, None, None, None, None, None)]
    rows += [(None, None, None, None, None, None, None, None, None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
