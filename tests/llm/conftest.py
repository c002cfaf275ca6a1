import pytest
from pyspark.sql import Row

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, `__found` int"

LONG = " ".join(f"word{i % 977} the of" for i in range(40_000))
PROSE = "The quick brown fox of the hill ran over the lazy dog and was seen by many in the town that day"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and columns whose names clash."""
    texts = [
        (1, PROSE, "en"),
        (1, PROSE, "en"),
        (2, PROSE, None),
        (None, PROSE, "en"),
        (None, None, None),
        (3, None, "fr"),
        (4, "", "fr"),
        (5, " \t\r\n\x0b", "de"),
        (6, "12 34 !!", "de"),
        (7, "une seule ligne avec des mots français déjà été", "fr"),
        (8, LONG, "en"),
        (9, LONG + " end", "en"),
        (10, "x" * 200_000, "en"),
        (11, "日本語 テキスト 😀", "ja"),
        (11, "ein anderer Text mit derselben Nummer", "de"),
        (12, "a\nb\na\n\n\nb", "en"),
    ]
    rows = [Row(i, t, l, None, len(t) if t else None, "clash", n) for n, (i, t, l) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
