import pytest

ODD = [
    # doc_id, text, lang, source, n_chars, and columns named like the operators' own
    (1, "The cat sat on the mat. " * 30, "en", "a", 720, "x", 1.5),
    (1, "The cat sat on the mat. " * 30, "en", "a", 720, "x", 1.5),
    (2, None, "en", "a", None, None, None),
    (3, "", None, None, 0, "", 0.0),
    (4, " \t\n\x0b\r ", "en", "a", 6, "x", 1.0),
    (5, "one", "en", "a", 3, "x", 1.0),
    (None, "no id here but some words", "en", None, 25, "x", 1.0),
    (None, None, None, None, None, None, None),
    (6, "A longer line.\n\nA longer line.\n  a LONGER   line.\n" + "word " * 60, "de", "b", 1, "x", 1.0),
    (7, "Ünïcödé wörds — 日本語 😀 é \x1c \x01 tab\tend  two  spaces \n x", "fr", "b", 1, "x", 1.0),
    (8, "long " + " ".join(f"w{i}" for i in range(30_000)), "en", "b", 1, "x", 1.0),
    (9, "Stop <|endoftext|> and <|startoftext|>now, it's DON'T we'll", "en", "b", 1, "x", 1.0),
    (10, "The cat sat on the mat. " * 30, "en", "a", 720, "y", 2.5),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, score double"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs, empty and very long texts, copies, repeated rows and clashing columns."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    return [(r[0], r[1] or "") for r in ODD]


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r["doc_id"], r["text"] or "") for r in small.select("doc_id", "text").collect()]
