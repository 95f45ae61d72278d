import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, id long, n int, spans string, ids binary, `__keep` int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with columns whose names operators might use themselves."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None, None)[:4]
            full.append((doc_id, text, lang, source, len(text or ""), 7, "k", 8, 9, "s", b"b", 3))
        return spark.createDataFrame(full, SCHEMA).repartition(3, "source", "doc_id")

    return make
