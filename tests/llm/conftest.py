import pytest


@pytest.fixture(scope="session")
def rows_of():
    """A frame's rows as sorted tuples of some columns; NULL first."""

    def of(frame, *columns):
        found = [tuple(r) for r in frame.select(*columns).collect()]
        return sorted(found, key=lambda r: [(v is not None, v) for v in r])

    return of


@pytest.fixture(scope="session")
def docs(spark):
    """A frame of documents from (doc_id, text), with other columns that operators must leave alone."""

    def of(*rows):
        schema = "doc_id long, text string, id string, version int, dropped string, score double, lang string"
        return spark.createDataFrame([(i, t, "x", 7, "y", 0.5, "en") for i, t in rows], schema)

    return of
