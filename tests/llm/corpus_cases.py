"""Fixtures of the corpus tests."""

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, score string, hash bigint, doc string"


@pytest.fixture
def documents(spark):
    """Documents of (id, text) or (id, text, lang), with columns whose names may clash."""
    def build(rows, parts=3):
        full = [(*row, None)[:3] for row in rows]
        return spark.createDataFrame(
            [(i, text, lang, "own", 5, "kept") for i, text, lang in full], DOCUMENT
        ).repartition(parts)
    return build


@pytest.fixture
def found():
    """Rows as a sorted list of tuples."""
    def rows(frame):
        return sorted(map(tuple, frame.collect()), key=repr)
    return rows
