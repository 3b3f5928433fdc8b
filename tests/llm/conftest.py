import pytest

AWKWARD = [
    None,
    "",
    " \n\t ",
    "word",
    "Ünïcode wörds \U0001f600 and no-break",
    "same text again " * 20,
    "same text again " * 20,
    "1" * 3000 + " " + "a" * 3000,
    ("alpha beta gamma delta " * 2500) + "mail me@example.org or +49 (30) 123 456 78",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """NULL ids, texts and sources, empty, blank and long texts, repeated rows, columns with unlucky names."""
    rows = [(k if k != 3 else None, t, "en" if k % 2 else None, "s" if k % 3 else None, k, "x") for k, t in enumerate(AWKWARD)]
    rows += [rows[5], rows[5]]
    names = "doc_id long, text string, lang string, source string, n_chars long, __key string"
    return spark.createDataFrame(rows, names).withColumnRenamed("__key", "rk").repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
