import pytest

#: Null, empty and blank texts, ties and repeated rows, odd white space, wide characters.
TEXTS = [
    None, "", "   ", "one", "two words", "a\n\nb  c\td ", "Ünïcode — 東京 🙂 text", "x" * 3000, "same text of a few words here", "same text of a few words here",
    "It's 5 kg, isn't it? <|endoftext|> yes", " leading and trailing ", "word " * 2000,
]
#: Columns whose names clash with those that operators make.
EXTRA = "shard int, slot string, score string, size string, component_id string, rule string, verdict string, n_tokens string, cid string, h string, node string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with odd texts, a null id and a repeated row."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None, None), (3, "one", "en", "s", 3)]
    extra = tuple([1] + ["x"] * 10)
    return spark.createDataFrame([r + extra for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
