import pytest
from pyspark.sql import functions as F

WORDS = "the of and that with river stone cloud winter garden letter window copper silver morning paper bridge".split()


@pytest.fixture(scope="session")
def docs(spark):
    """A few documents with every oddity: nulls in any column, empty texts, ties, repeated rows, a column name that clashes."""
    long_text = " ".join(WORDS[i * 7 % len(WORDS)] for i in range(30_000))
    rows = [
        (1, "the cloud and the river", "en", "a", 1.0),
        (2, "the  cloud\tand the river", "en", "a", 2.0),
        (3, None, "en", "a", 3.0),
        (4, "", None, "b", None),
        (5, " \n ", "en", None, 5.0),
        (6, long_text, "en", "b", 6.0),
        (7, long_text + " end", "en", "b", 7.0),
        (8, "der Fluss und die Wolke über der Brücke", "de", "b", 8.0),
        (8, "der Fluss und die Wolke über der Brücke", "de", "b", 8.0),
        (None, "the cloud and the river", "en", "a", 9.0),
        (None, None, None, None, None),
        (11, "12345 67890 !!!", "en", "a", 11.0),
        (12, "write to jo.doe@mail.example.com or +1 (212) 555-0199 from 10.0.0.7, card 4111 1111 1111 1111", "en", "c", 12.0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where(F.lit(False))


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
