import pytest

LONG = " ".join(f"w{i % 977}" for i in range(20_000))


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "start int, h1 string, class string, score double, n_lines long, prints string, text_hash long"
        )
        data = [(i, t, "en", "s", len(t or ""), 5, "x", "y", 0.5, 7, "z", 3) for i, t in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    return docs([
        (1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, LONG), (5, LONG), (None, "no id here"), (None, None),
        (6, "one"), (7, "one"), (8, "É ü ß 你好 🙂 \x00 end"),
    ])
