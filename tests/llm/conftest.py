import pytest


@pytest.fixture
def docs(spark):
    """Documents with null, empty, repeated and very long texts and clashing columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "a b c d e f g\nfooter line", "en", "s1", 3), (2, None, None, None, None), (3, "", "en", "s1", 0),
            (4, "a b c d e f g\nfooter line", "en", "s1", 3), (4, "a b c d e f g\nfooter line", "en", "s1", 3),
            (5, long, "fr", "s2", 1), (None, "x y", "en", "s1", 3), (6, " \n\t ", "de", "s2", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score int")
