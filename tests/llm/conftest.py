import pytest

from portalake.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return common.tune(spark)


@pytest.fixture
def docs(llm):
    """A function from (doc_id, text[, lang]) to a table of documents, with columns whose names the
    operators might use inside."""
    def make(*rows, extra=True):
        df = llm.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows], DOCS)
        if extra:
            for name in ("ids", "n", "key", "component", "rank", "text_key", "places", "row", "score", "x", "token", "a", "b"):
                df = df.withColumn(name, df["source"])
        return df
    return make
