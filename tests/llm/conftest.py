import pytest

EDGE = [
    (1, None, "en", "s", 0),
    (2, "", None, None, None),
    (3, "one", "en", "s", 3),
    (4, "Alpha beta gamma delta epsilon zeta " * 40, "en", "s", 5),
    (4, "Alpha beta gamma delta epsilon zeta " * 40, "en", "s", 5),
    (5, "Alpha beta gamma delta epsilon zeta " * 40, "fr", "s", 5),
    (None, "Éa über\tniño x  \r\n\n y's 12 £# 😀 é \x1c z", "de", "t", 1),
    (6, "w " * 30000 + "end", "en", "s", 1),
    (7, "   \n\t  ", "en", "s", 1),
    (8, "ab" * 500, "es", "s", 1),
    (9, "x" + "ab" * 300, "es", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    """Null and empty texts, a long text, ties, repeated rows, a null id and columns with clashing names."""
    names = ("fp", "root", "a", "b", "key", "k1", "k2", "piece", "start", "length", "digest", "n", "label")
    wide = SCHEMA + "".join(f", {x} string" for x in names)
    return spark.createDataFrame([r + ("clash",) * len(names) for r in EDGE], wide)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
