import pytest
from pyspark.sql import Row

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `__q` int, score string, found int, `__words` int"
LONG = " ".join(f"word{i % 997}x{i}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, blanks, a very long text, ties, repeated rows and clashing names."""
    def doc(i, text, source="s"):
        return Row(i, text, None, source, None, 1, "x", 2, 3)

    prose = "The cat of the house sat on the mat and looked at all the people who went by. "
    rows = [doc(1, None), doc(2, ""), doc(3, " \t\n\r\x0b\x0c "), doc(4, prose * 3), doc(5, prose * 3),
            doc(5, prose * 3), doc(None, prose), doc(None, None, None), doc(6, LONG, None), doc(7, "one"),
            doc(8, "é\x01ü \x02 \U0001F600 ok"), doc(9, "one two three four"), doc(9, "one two three four", None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
