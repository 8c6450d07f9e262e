import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from txsentry.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    yield local_session("*", shuffle_partitions=8, app="txsentry-tests")


def docs(spark, rows, extra=False):
    """Rows (doc_id, text[, lang[, source]]) as a documents table; ``extra`` adds columns
    whose names clash with those that operators use inside."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((*r, len(r[1]) if r[1] is not None else None))
    df = spark.createDataFrame(full, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for c in ("score", "key", "id", "rank", "fp", "root", "size", "copies", "n_words", "held_out", "label", "block"):
            df = df.withColumn(c, F.lit("x"))
    return df


EDGE = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "one two three four five six seven eight nine ten.", "en", "a"),
    (3, "one two three four five six seven eight nine ten.", "en", "a"),
    (None, "a row without an id, but with some words in it", "en", None),
    (5, "x " * 30000, None, "b"),
    (6, "\n\n \t\n", "en", "b"),
    (7, "é" * 50 + " ñandú 😀 中文", "es", ""),
]
