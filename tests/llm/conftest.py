import pytest

#: Null, empty, blank, very short, junk, repeated, long; ids null and repeated; a column that clashes with results.
TEXTS = [None, "", "  \n\t ", "one", "a b c", "a b c d e", "A b C d e", "x " * 5000, "mail me: a.b@c.de or +1 (234) 555-7890 now", "ab#$ cd| 1.2.3.4 4111 1111 1111 1111", "été über straße 日本語 🎉\x1c\x85 end", "w" * 30_000]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, component_id string"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(k, t, None, "s", None, 1.0, None, "x") for k, t in enumerate(TEXTS)]
    rows += [(5, "a b c d e", None, None, 3, None, None, None), (None, "a b c d e", "en", "s", 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
