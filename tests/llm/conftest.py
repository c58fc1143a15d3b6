import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as the operators' own ones; they have to be left alone.
CLASH = "id long, t string, h long, size long, row long, fp long, n_words long, taken long, score double, kept boolean, word string"


@pytest.fixture(scope="session")
def spark():
    from shelfaudit.session import local_session

    s = local_session(4, shuffle_partitions=4)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source), with clashing extra columns."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        schema = DOC
        if clash:
            extra = (-1, "x", -2, -3, -4, -5, -6, -7, 0.5, False, "y")
            full, schema = [r + extra for r in full], f"{DOC}, {CLASH}"
        return spark.createDataFrame(full, schema)

    return make


#: Nulls, empty, blank, long, repeated rows, ties, and text beyond ASCII.
LONG = " ".join(f"wort{i % 977} Straße{i % 31}" for i in range(40_000))
EDGE = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one  TWO"), (6, "One two three four"), (7, "One two three four"), (7, "One two three four"),
    (None, "One two three four"), (None, None), (8, LONG), (9, "ÄÖÜ ß é İ \U0001F600 token=abcdef12"), (10, "\x00\x01 nul"), (11, "a" * 50_000),
]
