import pytest


@pytest.fixture(scope="session")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, very long and equal texts, repeated and null ids, and columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away from here", "en"),
        (2, "The quick brown fox jumps over the lazy dog and runs away from here", "en"),
        (2, "The quick brown fox jumps over the lazy dog and runs away from here", "en"),
        (3, "", "en"),
        (4, None, None),
        (None, "two words", "en"),
        (None, None, None),
        (5, "  \n\t ", "de"),
        (6, "word " * 60_000, "de"),
        (7, "x" * 2_500_000, "de"),
        (8, "élan déjà vu là   naïve 日本語 text", "fr"),
        (9, "two words", "en"),
    ]
    data = [(i, t, lang, "host", 1, "n", "k", "s") for i, t, lang in rows]
    names = "doc_id long, text string, lang string, source string, n int, row_key string, label string, score string"
    return spark.createDataFrame(data, names)
