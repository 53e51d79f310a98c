import pytest

SF = "/root/testdata/sf0.001"
VOCABULARIES = "/opt/tokenizers"
LONG = "Alpha beta gamma delta, epsilon. " * 2500

# nulls in any column, empty and very long texts, ties, repeated rows
EDGES = [
    (1, "One two three four five six seven.", "en", "web", 34),
    (2, None, "en", "web", None),
    (3, "", None, None, 0),
    (4, "  \n\t ", "de", "books", 5),
    (5, LONG, "en", "web", len(LONG)),
    (6, LONG, "en", None, len(LONG)),
    (None, "A text without an id, twice. " * 20, "fr", "books", 1),
    (7, "same row", "en", "web", 8),
    (7, "same row", "en", "web", 8),
    (7, "same id, other text", "en", "web", 19),
    (8, "é ü ß 漢字 mail me: ann@site.example.org or +1 (988) 555-2485   end", "en", "", 3),
    (9, "word " * 300, "xx", "web", 1500),
]


@pytest.fixture
def edges(spark):
    """Documents of every odd kind, with extra columns named like the operators' own."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, row long, "
              "txt_key string, bucket int, rank string, n_words string")
    return spark.createDataFrame([(*r, 1, None, 2, "x", 3, "y", "z") for r in EDGES], schema)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
