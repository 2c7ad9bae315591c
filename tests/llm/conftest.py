import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Makes a documents table, with columns whose names clash with inner ones."""
    def make(texts, langs=None, sources=None, ids=None):
        n = len(texts)
        rows = [((ids or list(range(n)))[i], texts[i], (langs or ["en"] * n)[i],
                 (sources or ["a"] * n)[i], len(texts[i] or "")) for i in range(n)]
        df = spark.createDataFrame(rows, DOCUMENTS)
        return df.selectExpr("*", "1 AS size", "'x' AS spans", "2 AS fp", "'y' AS __s", "3 AS n_words",
                             "'z' AS text_key", "4 AS copies", "5 AS score")
    return make
