import pytest

AWKWARD = ["", " ", "\n\n", "x", "é😀漢字", "a\x00b", "word " * 3000, "n" * 20000]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, odd and long texts, repeated rows, null ids, and columns with clashing names."""
    rows = [(i, t, "z", i, 1, 2, 0.5, "s") for i, t in enumerate(AWKWARD)] + [(90, None, "z", 1, 1, 2, 0.5, "s"), (None, "some words here", "z", 1, 1, 2, 0.5, "s")] + 2 * [(3, "x", "z", 3, 1, 2, 0.5, "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, k1 int, k2 int, score double, spans string")
