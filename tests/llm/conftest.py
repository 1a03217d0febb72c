import pytest

from tests.conftest import DATA


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


@pytest.fixture
def docs_of(spark):
    """A table (doc_id, text, source and a column that clashes with results) from (doc_id, text, source)."""
    def made(*rows):
        full = [(*row, None)[:3] + ("own",) for row in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, source string, size string").repartition(3)

    return made


#: A null id and text, an empty text, one word, a long word, equal rows, one id twice.
ODD = [(None, "a b c d"), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "x" * 5000), (6, "a b c d"), (6, "a b c d"),
       (7, "p q r s"), (7, "other words here"), (-8, "a b c d"), (2**60 + 1, "big id")]


@pytest.fixture
def odd():
    return list(ODD)
