import pytest

#: Null, empty, blank, short and long texts, repeated rows, null ids, and a column that clashes with inner names.
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (None, "no id at all here, just text"),
    (6, "a b c d e f g h i j k l m n o p"), (7, "a b c d e f g h i j k l m n o p"), (7, "a b c d e f g h i j k l m n o p"),
    (8, "x" * 3000), (9, "na " * 5000), (10, "Der Fluß ist größer 漢字 🙂 als zuvor"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else "src", 7, "clash") for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key int, row string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def some_docs(spark):
    """Three hundred documents of the test data, whole texts."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
