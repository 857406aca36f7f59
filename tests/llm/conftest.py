import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from texts; an extra column carries a name that operators use for results."""

    def build(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src", None if t is None else len(t), "own") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")

    return build


LONG = " ".join(f"w{i % 5003}x" for i in range(60_000))
ODD = [None, "", " ", "\n\t", "a", "a b c d", "Same text here.", "Same  text here.", "Same text here.", LONG, LONG + " end"]


@pytest.fixture(scope="session")
def odd_texts():
    return list(ODD)
